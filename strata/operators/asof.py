"""As-of joins to long version histories by interval bins.

An equality join on the key followed by a date range pairs every fact with every version of its
key: with thousands of versions on one key the join makes thousands of rows for each fact. Here
time is cut into bins. A fact lies in one bin; a version belongs to the bin it starts in, and to
every bin that holds facts of its key and begins while the version is valid, which is at most one
version for each such bin. The join on (key, bin) then meets the versions that start inside
the bin and the one carried into it, however long the history is, and a hot key's facts are
spread over its bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bin(day, bin_days: int) -> Column:
    return F.floor(F.unix_date(day) / bin_days).cast("int")


def carried(bins: DataFrame, versions: DataFrame, bin_days: int) -> DataFrame:
    """For each used (k, b) of `bins` the version (k, start, end, v) valid when the bin begins.
    Versions of a key don't overlap, so that is the last one started before, if still open."""
    edge = F.date_from_unix_date(F.col("b") * bin_days)
    marks = bins.select("k", edge.alias("at"), F.lit(1).alias("is_bin"), "b", F.lit(None).cast(
        versions.select(F.struct("start", "end", "v")).schema[0].dataType).alias("s"))
    starts = versions.select("k", F.col("start").alias("at"), F.lit(0).alias("is_bin"), F.lit(None).cast("int").alias("b"),
                             F.struct("start", "end", "v").alias("s"))
    # a row for each used bin and each version of a key, whatever the number of facts
    before = Window.partitionBy("k").orderBy("at", "is_bin").rowsBetween(Window.unboundedPreceding, 0)
    last = marks.unionByName(starts).withColumn("s", F.last("s", ignorenulls=True).over(before)).where("is_bin = 1")
    return (last.where(F.col("s").isNotNull() & (F.col("s.end").isNull() | (F.col("s.end") > F.col("at")))
                       & (F.col("s.start") < F.col("at")))
            .select("k", "b", "s.*"))


def asof_join(facts: DataFrame, versions: DataFrame, fact_key: str, dim_key: str, fact_date: str | Column,
              start: str, end: str, how: str = "left", bin_days: int = 16) -> DataFrame:
    """Each fact with the version of its key whose half-open interval [start, end) holds the fact's
    date (end NULL: open): the same rows as `model.temporal_join` with half-open intervals, for
    histories whose versions don't overlap. how: 'left' keeps facts without a version.

    A NULL key, date or start meets nothing; versions with end <= start are empty. All columns of
    both sides are returned. `bin_days` bounds what a fact meets: the versions that start in as
    many days, and one more."""
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    day = F.to_date(F.col(fact_date) if isinstance(fact_date, str) else fact_date)
    f = facts.withColumns({"__k": F.col(fact_key), "__day": day}).withColumn("__b", _bin(F.col("__day"), bin_days))
    inner = [F.col(c).alias(f"__v{i}") for i, c in enumerate(versions.columns)]
    v = (versions.where(F.col(dim_key).isNotNull() & F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col(start))))
         .select(F.col(dim_key).alias("k"), F.to_date(start).alias("start"), F.to_date(end).alias("end"), F.struct(*inner).alias("v")))
    bins = f.where("__k is not null and __b is not null").select(F.col("__k").alias("k"), F.col("__b").alias("b")).distinct()
    placed = v.withColumn("b", _bin(F.col("start"), bin_days)).select("k", "b", "start", "end", "v") \
        .unionByName(carried(bins, v, bin_days).select("k", "b", "start", "end", "v"))
    placed = placed.toDF("__pk", "__pb", "__start", "__end", "__v")         # names facts don't have
    hit = ((F.col("__k") == F.col("__pk")) & (F.col("__b") == F.col("__pb")) & (F.col("__day") >= F.col("__start"))
           & (F.col("__end").isNull() | (F.col("__day") < F.col("__end"))))
    return f.join(placed, hit, how).select(*[F.col(c) for c in facts.columns],
                                           *[F.col(f"__v.__v{i}").alias(c) for i, c in enumerate(versions.columns)])
