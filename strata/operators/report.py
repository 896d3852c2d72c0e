"""Consolidated violation table, per-rule report, audit rows and the run ledger."""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..context import RunContext


def union_all(frames: Iterable[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Bag union by column name; columns missing in a frame become typed NULLs."""
    frames = list(frames)
    if not frames:
        raise ValueError("union_all needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def consolidate(spark: SparkSession, table_names: Sequence[str]) -> DataFrame | None:
    """Union of the violation tables that exist in the catalog (absent ones skipped)."""
    found = [spark.table(t) for t in table_names if spark.catalog.tableExists(t)]
    return union_all(found) if found else None


def consolidate_paths(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet") -> DataFrame | None:
    """Union of the violation folders that exist (absent ones skipped), by column name."""
    from pyspark.errors import AnalysisException
    found = []
    for p in paths:
        try:
            found.append(spark.read.format(fmt).load(p))
        except AnalysisException:
            continue
    return union_all(found) if found else None


def violation_report(violations: DataFrame, by: Sequence[str] = ("violated_rule_id",)) -> DataFrame:
    """Count of violations per rule (and any other grouping columns)."""
    return violations.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def audit_rows(metrics: DataFrame, ctx: RunContext, target_table: str, action: str = "WRITE",
               database: str = "", query_label: str = "", rows_col: str = "n_valid") -> DataFrame:
    """One audit record per step, computed from that step's metrics frame.

    Values are bound as literals of a projection, never spliced into SQL text.
    """
    return metrics.select(
        F.lit(ctx.as_of).cast("timestamp").alias("event_timestamp"),
        F.lit(ctx.principal).alias("user_identity"),
        F.lit(action).alias("action_type"),
        F.lit(target_table).alias("target_table"),
        F.lit(database).alias("target_database"),
        F.lit(query_label).alias("query_text"),
        F.lit(ctx.run_id).alias("pipeline_run_id"),
        F.col(rows_col).cast("bigint").alias("n_rows"),
    )


def observe_counts(df: DataFrame, name: str, flag_col: str | None = None) -> tuple[DataFrame, Observation]:
    """Attach row counts that are collected by whatever action runs `df` (no extra job)."""
    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows")]
    if flag_col:
        exprs += [F.count_if(F.col(flag_col)).alias("flagged")]
    return df.observe(obs, *exprs), obs


class Ledger:
    """Run ledger: one row per step (step, status, rows in/out, seconds, run id)."""

    SCHEMA = ("step string, status string, rows_in bigint, rows_out bigint, "
              "seconds double, pipeline_run_id string")

    def __init__(self, ctx: RunContext):
        self.ctx, self.rows = ctx, []

    @contextmanager
    def step(self, name: str, rows_in: int | None = None):
        t0, rec = time.perf_counter(), {"rows_in": rows_in, "rows_out": None}
        try:
            yield rec
            status = "OK"
        except Exception:
            status = "FAILED"
            raise
        finally:
            self.rows.append((name, status, rec.get("rows_in"), rec.get("rows_out"),
                              round(time.perf_counter() - t0, 3), self.ctx.run_id))

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, self.SCHEMA)
