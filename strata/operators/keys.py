"""Surrogate keys: dense, ordered, stable across loads — without a global window.

`row_number() over (order by k)` has no partition clause, so Spark moves every row to
a single task. Here the rows are range-partitioned on the key (sampled bounds), sorted
inside each range, checkpointed into the shared checkpoint folder (so both uses below
see the same partitions, and a lost executor re-reads files instead of re-sampling),
and numbered as `offset(partition) + position in partition`; the offsets come from the
per-partition counts (a frame with one row per partition), so no row ever leaves its task.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def dense_keys(df: DataFrame, order_cols: Sequence[str], sk_col: str, start: int = 1,
               n_ranges: int | None = None) -> DataFrame:
    """Number the rows of `df` start, start+1, ... in `order_cols` order (ties arbitrary)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = n_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order_cols = list(order_cols)
    # secondary range column: rows sharing one order value (a hot value) may still be
    # spread over several ranges; numbering stays in order-column order
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    ranged = (df.withColumn("__spread", spread).repartitionByRange(n, *order_cols, "__spread")
              .sortWithinPartitions(*order_cols, "__spread").drop("__spread")
              .checkpoint(eager=True))
    pid = F.spark_partition_id()
    # only the row counts (one number per partition) reach the driver, as in RDD.zipWithIndex;
    # their running sums go back as a frame joined by partition number
    counts = sorted(ranged.groupBy(pid.alias("p")).count().collect())
    before = list(accumulate([n for _, n in counts], initial=0))
    offsets = spark.createDataFrame([(p, o) for (p, _), o in zip(counts, before)], "__p int, __off bigint")
    pos = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)
    placed = ranged.withColumns({"__p": pid, "__pos": pos})
    return (placed.join(F.broadcast(offsets), "__p")       # at most one row per range
            .withColumn(sk_col, (F.col("__off") + F.col("__pos") + F.lit(start)).cast("bigint"))
            .drop("__p", "__off", "__pos"))


def assign_keys(rows: DataFrame, natural_key: Sequence[str], sk_col: str,
                key_map: DataFrame | None = None) -> DataFrame:
    """Attach surrogate keys to `rows` (one row per natural key).

    Keys already in `key_map` (natural key + sk) keep their value; new natural keys are
    numbered densely from max(existing) + 1 — so re-running a load never re-keys facts.
    """
    nk = list(natural_key)
    if key_map is None:
        return dense_keys(rows, nk, sk_col)
    # one left join (its shuffles are reused by both branches), split on the missing key
    j = rows.join(key_map.select(*nk, F.col(sk_col).alias("__sk")), nk, "left")
    known = j.filter(F.col("__sk").isNotNull()).withColumnRenamed("__sk", sk_col)
    fresh = j.filter(F.col("__sk").isNull()).drop("__sk")
    top = key_map.agg(F.max(sk_col)).first()[0] or 0   # one scalar
    return known.unionByName(dense_keys(fresh, nk, sk_col, start=int(top) + 1))


def key_map(dim: DataFrame, natural_key: Sequence[str], sk_col: str) -> DataFrame:
    return dim.select(*natural_key, sk_col)
