"""Latest-wins ranking per business key, safe under heavy key skew.

`row_number() over (partition by key order by ...)` sends every row of a key to one task. Two
forms avoid that:

* `winners`: keeping only row_number = 1 lets Spark drop the others inside each map task
  before its one shuffle, so a hot key costs a row per task;
* `mark_latest`, which keeps the losers too, ranks in two steps: first among a key's rows of
  one input split (no group is larger than a split), then among the split winners.

A hash of the whole row follows the caller's order, so ties are broken the same way every
time; rows that are equal in all columns are copies, of which exactly one wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_row_locator(df: DataFrame, name: str = "_row_locator") -> DataFrame:
    """Physical locator (file path, row index) of a file-scanned frame.

    Deterministic under task retry, unlike `monotonically_increasing_id()` on shuffled data;
    makes exact copies distinguishable so exactly one of them wins.
    """
    loc = F.concat_ws("#", F.col("_metadata.file_path"),
                      F.col("_metadata.row_index").cast("string"))
    return df.withColumn(name, loc)


def _row_hash(df: DataFrame) -> Column:
    """Hash of all columns Spark can hash (maps can't be; they don't take part)."""
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()
             and f.dataType.simpleString() != "variant"]
    return F.xxhash64(*[F.col(c) for c in plain])


def _ranking(order: Sequence[str]) -> list[Column]:
    return [*[F.col(c).desc() for c in order], F.col("__tie").desc()]


def winners(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The one latest row of each key (a NULL key is a key): one scan, one shuffle."""
    w = Window.partitionBy(*keys).orderBy(*_ranking(order))
    return (df.withColumn("__tie", _row_hash(df)).withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") == 1).drop("__rn", "__tie"))


def mark_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], flag: str = "_is_latest",
                where: Column | None = None) -> DataFrame:
    """Add `flag`: True for exactly one latest row per key, False for superseded rows and the
    other copies of the winner, NULL for rows excluded by `where` (they take no part)."""
    keys = list(keys)
    part = df.withColumns({"__tie": _row_hash(df), "__split": F.spark_partition_id(),
                           "__in": F.lit(True) if where is None else F.coalesce(where, F.lit(False))})
    in_split = Window.partitionBy(*keys, "__in", "__split").orderBy(*_ranking(order))
    ranked = part.withColumn("__rn", F.row_number().over(in_split))
    beaten = ranked.filter(~F.col("__in") | (F.col("__rn") > 1)).withColumn("__first", F.lit(False))
    overall = Window.partitionBy(*keys).orderBy(*_ranking(order), F.col("__split"))
    best = (ranked.filter(F.col("__in") & (F.col("__rn") == 1))
            .withColumn("__first", F.row_number().over(overall) == 1))
    every = beaten.unionByName(best)
    return every.withColumn(flag, F.when(F.col("__in"), F.col("__first"))).drop(
        "__tie", "__split", "__in", "__rn", "__first")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(winners, superseded) of one ranked frame."""
    m = mark_latest(df, keys, order, flag="__latest")
    return (m.filter(F.col("__latest")).drop("__latest"),
            m.filter(~F.col("__latest")).drop("__latest"))
