"""Calendar attributes and date keys, all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c: str | Column) -> Column:
    """yyyyMMdd integer key of a date / timestamp (no string formatting round trip)."""
    d = F.to_date(_as_col(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_columns(d: str | Column) -> dict[str, Column]:
    """Attributes of the date dimension (fiscal quarter = calendar quarter)."""
    d = _as_col(d)
    return {
        "timestamp_sk": F.date_format(d, "yyyyMMdd").cast("int"),
        "y": F.year(d),
        "q": F.quarter(d),
        "m": F.month(d),
        "dom": F.dayofmonth(d),
        "is_year_end": (F.month(d) == 12) & (F.dayofmonth(d) == 31),
        "month_name": F.date_format(d, "MMMM"),
        "mon": F.date_format(d, "MMM"),
        "w": F.weekofyear(d),
        "dow": F.dayofweek(d),  # 1 = Sunday
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": F.dayofweek(d).isin(1, 7),
        "is_month_end": d == F.last_day(d),
        "fq": F.concat(F.lit("FQ"), F.quarter(d).cast("string")),
    }


def shift_days(c: str | Column, days: int) -> Column:
    return F.date_add(F.to_date(_as_col(c)), days)


def shift_seconds(c: str | Column, seconds: int) -> Column:
    return F.timestamp_add("SECOND", F.lit(seconds), _as_col(c))
