"""Validation checks. Each returns a small result frame computed by Spark, never a
driver-side loop over rows; `check_row` turns a count into the standard result shape
(check, target, severity, status, n_bad, pipeline_run_id).

Keys are pre-aggregated (partial, map-side) before any join, so a key holding a third
of a table costs one row per map task, not one hot join partition.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..context import RunContext
from .joins import join_null_safe


class CheckFailed(AssertionError):
    pass


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of `child` whose key has no match in `parent` (NULL key counts as orphan).

    The parent side is reduced to its distinct keys first (partial aggregation), so the
    anti join shuffles one row per key and map task instead of every parent row.
    """
    keys = parent.select(F.col(parent_key).alias("__pk")).distinct()
    return child.join(keys, F.col(child_key) == F.col("__pk"), "left_anti")


def fk_violations(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
                  source_table: str, rule_id: str, record_key: str | None = None,
                  locator: str | None = None, ctx: RunContext | None = None,
                  description: str = "orphan foreign key") -> DataFrame:
    """Cross-table FK check as violation records (action WARN: the row is kept).

    record_key = the child row's own key (default: the FK column); field_name /
    field_value = the FK column and its dangling value. `locator` tells child rows apart; by
    default it is a hash of the whole row (orphans share FK values, also NULL).
    """
    from .rules import WARN, violations
    o = orphans(child, parent, child_key, parent_key)
    rk = record_key or child_key
    return violations(o, source_table, rk, locator, rule_id=rule_id,
                      descriptions={rule_id: description}, action=WARN, ctx=ctx,
                      field_name=child_key, field_value=F.col(child_key))


def count_orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return orphans(child, parent, child_key, parent_key).agg(F.count(F.lit(1)).alias("n"))


def reconcile(src: DataFrame, dst: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row counts on both sides plus missing and extra rows by key, in one join.

    Each side is first counted per key; the full outer join then pairs unique keys (NULL is
    a key), so equal totals with different keys, and lost or added copies, are caught.
    """
    keys = list(keys)
    a = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("__na"))
    b = dst.groupBy(*keys).agg(F.count(F.lit(1)).alias("__nb"))
    j = join_null_safe(a, b, keys, "full_outer").na.fill(0, ["__na", "__nb"])
    na, nb = F.col("__na"), F.col("__nb")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return j.agg(total(na).alias("n_src"), total(nb).alias("n_dst"),
                 total(F.greatest(na - nb, F.lit(0))).alias("n_missing"),
                 total(F.greatest(nb - na, F.lit(0))).alias("n_extra"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count of every listed column in a single pass (one row, one column each)."""
    columns = list(columns or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in columns])


def missing_dates(facts: DataFrame, fact_date: str | Column, dates: DataFrame,
                  dim_date: str | Column) -> DataFrame:
    """Fact rows whose date has no row in the date table (anti join on distinct dates)."""
    fd = F.col(fact_date) if isinstance(fact_date, str) else fact_date
    dd = F.col(dim_date) if isinstance(dim_date, str) else dim_date
    d = dates.select(F.to_date(dd).alias("__dim_day")).distinct()
    return facts.join(d, F.to_date(fd) == F.col("__dim_day"), "left_anti")


def distinct_count(df: DataFrame, column: str, alias: str = "n") -> DataFrame:
    return df.agg(F.count_distinct(column).cast("bigint").alias(alias))


def unmasked_count(df: DataFrame, column: str, suffix: str = "***", null_ok: bool = False) -> DataFrame:
    """Whole-column masking check (not a 10-row sample). NULL counts as unmasked unless
    `null_ok` (a NULL value reveals nothing)."""
    c = F.col(column)
    like = F.coalesce(c, F.lit("")).like("%" + suffix.replace("%", r"\%"))
    bad = ~like & c.isNotNull() if null_ok else ~like
    return df.agg(F.count_if(bad).cast("bigint").alias("n"))


def schema_gaps(df: DataFrame, required: Iterable[str], optional: Iterable[str] = ()) -> dict:
    """Missing required columns and unexpected extra ones (schema metadata only)."""
    have = set(df.columns)
    req = list(required)
    return {"missing": [c for c in req if c not in have],
            "unexpected": sorted(have - set(req) - set(optional))}


def require_columns(df: DataFrame, required: Iterable[str]) -> None:
    gaps = schema_gaps(df, required)["missing"]
    if gaps:
        raise CheckFailed(f"missing required columns: {gaps}")


def check_row(check: str, target: str, severity: str, n_bad: DataFrame,
              ctx: RunContext | None = None, col: str = "n") -> DataFrame:
    """Standard result row from a one-row count frame; status FAIL when n_bad > 0."""
    ctx = ctx or RunContext(run_id="unset")
    n = F.col(col).cast("bigint")
    return n_bad.select(F.lit(check).alias("check"), F.lit(target).alias("target"),
                        F.lit(severity).alias("severity"),
                        F.when(n > 0, F.lit("FAIL")).otherwise(F.lit("PASS")).alias("status"),
                        n.alias("n_bad"), F.lit(ctx.run_id).alias("pipeline_run_id"))


CHECK_SCHEMA = T.StructType([
    T.StructField("check", T.StringType()), T.StructField("target", T.StringType()),
    T.StructField("severity", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("n_bad", T.LongType()), T.StructField("pipeline_run_id", T.StringType()),
])


def enforce(results: DataFrame) -> DataFrame:
    """Collect the (tiny) check results and raise if an ERROR-severity check failed."""
    rows = results.collect()
    bad = [r for r in rows if r["severity"] == "ERROR" and r["status"] == "FAIL"]
    if bad:
        raise CheckFailed("; ".join(f"{r['check']}({r['target']}): {r['n_bad']}" for r in bad))
    return results
