"""Current-state and versioned tables as numbered snapshots.

A new state is written to a folder of its own and readers take the newest complete one, so
nothing is overwritten while it is read, a reader sees the old state or the new one, and a job
that dies leaves a folder without its success mark that the retry replaces. Rewriting only the
files a batch touches is the storage engine's MERGE and not rebuilt here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources.writers import conform, write_snapshot


def versions(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the complete snapshots under `base` (file-system metadata only)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = []
    for s in fs.listStatus(path):
        name = s.getPath().getName()
        if name.startswith("v=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")):
            found.append(int(name[2:]))
    return sorted(found)


def read(spark: SparkSession, base: str, schema: T.StructType, at_most: int | None = None) -> DataFrame:
    """The newest complete snapshot (up to version `at_most`); an empty frame if there is none."""
    known = [v for v in versions(spark, base) if at_most is None or v <= at_most]
    if not known:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{base.rstrip('/')}/v={known[-1]:08d}")


def advance(spark: SparkSession, base: str, batch: DataFrame, plan: Callable[[DataFrame, DataFrame], DataFrame],
            schema: T.StructType, version: int | None = None) -> int:
    """Write `plan(current, batch)` as the next snapshot and return its number. With `version`
    (a micro-batch's number) a replay reads the state before it and replaces its own output."""
    number = version if version is not None else max(versions(spark, base), default=-1) + 1
    current = read(spark, base, schema, at_most=number - 1)
    write_snapshot(conform(plan(current, batch), schema), base, number)
    return number
