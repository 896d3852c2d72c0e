"""Facts stored by date and read through the date dimension.

The fact carries the day's key and lies in folders of a period (a day, month or year) computed from it. A
join with chosen days of the dimension goes over both keys, so Spark finds the periods of those
days at run time and reads only their folders (dynamic partition pruning); the fact needs no
filter of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key
from ..sources import writers

#: Digits that a period's key drops from a yyyyMMdd key.
_DROPPED = {"day": 0, "month": 2, "year": 4}


def period_key(day_key: str | Column, period: str) -> Column:
    """yyyyMMdd, yyyyMM or yyyy key of a yyyyMMdd key."""
    k = F.col(day_key) if isinstance(day_key, str) else day_key
    return F.floor(k / 10 ** _DROPPED[period]).cast("int")


def write_by_date(df: DataFrame, path: str, date_col: str, key: str = "date_sk", period: str = "month",
                  mode: str = "append") -> None:
    """Write `df` with the key of its date, partitioned by `<key>_<period>`. Rows without a date go
    to the NULL partition. A period with much of the data is split over several files."""
    k = date_key(date_col)
    keyed = df.withColumns({key: k, f"{key}_{period}": period_key(k, period)})
    writers.write_partitioned(keyed, path, [f"{key}_{period}"], mode=mode)


def join_dates(fact: DataFrame, dates: DataFrame, key: str = "date_sk", period: str = "month",
               day_key: str = "timestamp_sk") -> DataFrame:
    """Facts of the days in `dates` (one row per `day_key`), with the dimension's columns.

    `fact` was written by `write_by_date`; rows without a date meet no day. The folders of
    other periods are not read if Spark broadcasts `dates` (a calendar, filtered) and its plan
    shows a filter on it."""
    part = f"{key}_{period}"
    days = dates.withColumn("__period", period_key(day_key, period))
    on = (fact[part] == days["__period"]) & (fact[key] == days[day_key])
    return fact.join(days, on).drop("__period", part, day_key)
