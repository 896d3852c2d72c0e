"""Writers: schema conformance, run-keyed idempotent appends, partitioned and versioned
snapshot writes. No `coalesce(1)`: output files are as parallel as the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_COL = "_pipeline_run_id"


def conform(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Project `df` onto `schema`: explicit casts, typed NULLs for absent columns,
    extra columns dropped (an `INSERT INTO t(cols) SELECT ...` without the table).

    strict=True raises on a missing column instead of filling NULL.
    """
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in have:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif strict:
            raise ValueError(f"column {f.name} missing")
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def enforce_required(df: DataFrame, columns: Sequence[str], table: str = "table") -> DataFrame:
    """`df` whose plan fails on a NULL in one of `columns` (a NOT NULL constraint). It is evaluated in
    the tasks that write the rows, without another pass over them; a column that a later step
    prunes is not looked at, so this comes last before the write. After a `limit` rows beyond the
    limit may be looked at too."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"{table} lacks the required columns {absent}")
    return df.withColumns({c: F.coalesce(F.col(c), F.raise_error(F.lit(f"{table}.{c} must not be NULL"))
                                         .cast(df.schema[c].dataType)) for c in columns})


def split_required(df: DataFrame, columns: Sequence[str], reason: str = "_null_columns") -> tuple[DataFrame, DataFrame]:
    """(complete rows, rows with a NULL in one of `columns`); `reason` names the NULL columns."""
    empty = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]).cast("array<string>"),
                     lambda x: x.isNotNull())
    marked = df.withColumn(reason, F.concat_ws(",", empty))
    return (marked.where(F.col(reason) == "").drop(reason), marked.where(F.col(reason) != ""))


def write_required(df: DataFrame, path: str, columns: Sequence[str], quarantine: str | None = None,
                   fmt: str = "parquet", mode: str = "append", table: str = "table") -> None:
    """Append to a table whose `columns` may hold no NULL. Without `quarantine` a NULL fails the
    write, and none of its rows become visible; with it such rows go to that folder with the names
    of their NULL columns, and the rest is written under the same constraint."""
    good = df
    if quarantine:
        good, bad = split_required(df, columns)
        bad.write.format(fmt).mode(mode).save(quarantine)
    enforce_required(good, columns, table).write.format(fmt).mode(mode).save(path)


def run_folder(path: str, run_id: str) -> str:
    return f"{path.rstrip('/')}/{RUN_COL}={quote(run_id, safe='._- ')}"


def write_run(df: DataFrame, path: str, run_id: str, fmt: str = "parquet",
              partition_by: Sequence[str] = ()) -> None:
    """Append keyed by run: each run is a folder of its own that a retry replaces as a whole, so
    it never doubles rows and leaves none of an earlier attempt (also with fewer sub-partitions
    or no rows). Reading `path` gives the run as a partition column."""
    folder = run_folder(path, run_id)
    out = df.drop(RUN_COL)
    w = (out.hint("rebalance", *partition_by) if partition_by else out).write.format(fmt).mode("overwrite")
    w.option("partitionOverwriteMode", "static").partitionBy(*partition_by).save(folder)


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet",
                      mode: str = "append", max_records_per_file: int | None = None) -> None:
    """Partitioned write. A REBALANCE on the partition columns lets AQE split hot
    partition values (a facility with a third of the rows) into several files/tasks
    instead of one task per value, and merge tiny ones."""
    w = df.hint("rebalance", *partition_by).write.format(fmt).mode(mode).partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.save(path)


def write_snapshot(df: DataFrame, base: str, version: int, fmt: str = "parquet") -> str:
    """Write a new version folder; never the path the plan is reading. A retried job
    replaces its own half-written version (nothing else reads it yet)."""
    path = f"{base.rstrip('/')}/v={version:08d}"
    df.write.format(fmt).mode("overwrite").save(path)
    return path


def write_landing(df: DataFrame, path: str, fmt: str, **options) -> None:
    """Landing-file writer (JSON / CSV / Parquet), one file per task; a retried job
    replaces its own output."""
    df.write.format(fmt).options(**options).mode("overwrite").save(path)


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], n_buckets: int,
                   fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Catalog table bucketed and sorted on the join key: two tables bucketed the same
    way join without shuffling either side (co-located sort-merge join)."""
    (df.write.format(fmt).mode(mode).bucketBy(n_buckets, *keys).sortBy(*keys)
     .saveAsTable(table))
