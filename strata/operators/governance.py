"""Governed views: row scope by entitlement (default deny) and column masking.

Row scope is a left-semi join against the principal's entitlements — the rewrite
Catalyst applies to an `IN (subquery)` anyway — so it scales with an entitlement table
instead of a CASE over user names. An unmapped principal sees nothing; "all rows" is
an explicit entitlement, never a fallback.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the entitlement value granting every row.
ALL = "ALL"


def allowed_values(entitlements: DataFrame, principal: str, principal_col: str = "principal",
                   value_col: str = "scope_value") -> DataFrame:
    return (entitlements.filter(F.col(principal_col) == F.lit(principal))
            .select(F.col(value_col).cast("string").alias("__scope")).distinct())


def row_scope(df: DataFrame, scope_col: str, entitlements: DataFrame, principal: str,
              principal_col: str = "principal", value_col: str = "scope_value") -> DataFrame:
    """Rows of `df` whose `scope_col` the principal is entitled to (default deny)."""
    # The entitlements are read whenever the result is, so a revoked grant takes effect in a
    # view published before. A grant of everything stands for every scope the data has: the
    # distinct scopes of the data (partly aggregated) kept if that grant exists.
    allowed = allowed_values(entitlements, principal, principal_col, value_col)
    everything = allowed.filter(F.col("__scope") == ALL).select(F.lit(True).alias("__all")).distinct()
    # Cast the small entitlement side to the data column's type, not the other way
    # round, so the big side keeps its native join key.
    typed = allowed.select(F.expr(f"try_cast(__scope as {df.schema[scope_col].dataType.simpleString()})").alias("__scope")).filter(F.col("__scope").isNotNull())
    scopes = df.select(F.col(scope_col).alias("__scope")).distinct().withColumn("__one", F.lit(True))
    granted = scopes.join(everything, F.col("__one") == F.col("__all"), "left_semi").select("__scope")
    scope = typed.unionByName(granted).distinct()
    return df.join(scope, F.col(scope_col).eqNullSafe(F.col("__scope")), "left_semi")


def mask_columns(df: DataFrame, masks: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """Replace each listed column by its masked form, keeping column order."""
    return df.select(*[masks[c](F.col(c)).alias(c) if c in masks else F.col(c) for c in df.columns])


def governed_view(df: DataFrame, masks: Mapping[str, Callable[[Column], Column]] | None = None,
                  deleted_col: str | None = "is_deleted", include_deleted: bool = False) -> DataFrame:
    """Analyst view: masked columns, and soft-deleted rows hidden unless asked for."""
    out = df
    if deleted_col and deleted_col in df.columns and not include_deleted:
        out = out.filter(~F.coalesce(F.col(deleted_col), F.lit(False)))
    return mask_columns(out, masks or {})


def publish_view(spark: SparkSession, name: str, df: DataFrame) -> None:
    df.createOrReplaceTempView(name)


def register_scope_function(spark: SparkSession, name: str, mapping: Mapping[str, str],
                            default: str | None = None) -> None:
    """SQL function `name()` mapping `current_user()` to a scope value.

    Catalyst folds it to a constant, so a view filtering on it keeps one literal
    predicate. `default=None` means an unmapped user maps to NULL (sees nothing).
    """
    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"
    branches = " ".join(f"WHEN {q(u)} THEN {q(v)}" for u, v in mapping.items())
    other = f" ELSE {q(default)}" if default is not None else ""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}() RETURNS STRING "
              f"RETURN CASE current_user() {branches}{other} END")
