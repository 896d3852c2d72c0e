"""Star-schema builders: date spine, dimensions from facts, key lookups, temporal
(as-of) joins, multi-dimension star joins and the fact grain check.

Join strategy is Spark's: no hints and no size probes. Adaptive execution broadcasts a side
whose measured size is under the session's threshold and otherwise keeps the shuffle join,
where it splits skewed partitions (one hot key cannot pin a single task).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import calendar_columns
from .keys import assign_keys

# Fixed value: the unknown-member key used when a fact finds no dimension row.
UNKNOWN_SK = -1


def date_spine(bounds: DataFrame, start: str | Column, end: str | Column,
               name: str = "date_day") -> DataFrame:
    """One row per day between the (one-row) bounds, derived by Spark from the data."""
    s = F.to_date(F.col(start) if isinstance(start, str) else start)
    e = F.to_date(F.col(end) if isinstance(end, str) else end)
    return bounds.select(F.explode(F.sequence(s, e, F.expr("interval 1 day"))).alias(name))


def date_dimension(spine: DataFrame, day: str = "date_day") -> DataFrame:
    return spine.withColumns(calendar_columns(day))


def dimension_from_fact(facts: DataFrame, natural_key: str, attrs: Mapping[str, Column],
                        sk_col: str, key_map: DataFrame | None = None) -> DataFrame:
    """Distinct non-NULL keys of a fact column, with attributes and surrogate keys."""
    keys = facts.select(natural_key).where(F.col(natural_key).isNotNull()).distinct()
    return assign_keys(keys.withColumns(dict(attrs)), [natural_key], sk_col, key_map)


def lookup_keys(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, sk_col: str,
                on_missing: str = "unknown") -> DataFrame:
    """Replace a natural key by the dimension's surrogate key.

    on_missing: 'unknown' → UNKNOWN_SK, 'drop' → inner join, 'null' → NULL key.
    """
    d = dim.select(F.col(dim_key).alias("__dk"), F.col(sk_col).alias("__sk"))
    how = "inner" if on_missing == "drop" else "left"
    j = facts.join(d, F.col(fact_key) == F.col("__dk"), how)
    sk = F.coalesce(F.col("__sk"), F.lit(UNKNOWN_SK).cast("bigint")) if on_missing == "unknown" \
        else F.col("__sk")
    return j.withColumn(sk_col, sk).drop("__dk", "__sk")


def temporal_join(facts: DataFrame, versions: DataFrame, fact_key: str, dim_key: str,
                  fact_date: str | Column, start: str, end: str, half_open: bool = True,
                  how: str = "inner") -> DataFrame:
    """Join each fact to the dimension version valid on its date.

    Equality on the key plus `start <= d < end` (open end = NULL). Half-open intervals
    give at most one version per date when versions abut (close day = next start day).
    """
    d = F.to_date(F.col(fact_date) if isinstance(fact_date, str) else fact_date)
    upper = (d < F.col(end)) if half_open else (d <= F.col(end))
    cond = (F.col(fact_key) == F.col(dim_key)) & (d >= F.col(start)) & (upper | F.col(end).isNull())
    return facts.join(versions, cond, how)


def star_join(facts: DataFrame, dims: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Chain of inner joins fact → dimension (fact_key, dim_key)."""
    out = facts
    for dim, fk, dk in dims:
        out = out.join(dim, F.col(fk) == F.col(dk), "inner")
    return out


def grain_violations(joined: DataFrame, driving: Sequence[str]) -> DataFrame:
    """Driving rows that matched more than once (fact rows should equal driving rows)."""
    return (joined.groupBy(*driving).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def production_measures(ordered: Column, rejected: Column, inspected: Column | None = None,
                        passed: Column | None = None) -> dict[str, Column]:
    """Both yield definitions as named, guarded measures (no division error, no silent
    choice): on ordered quantity, and — when inspection figures exist — on inspected."""
    from ..functions.expressions import guarded_ratio
    out = {"units_passed": ordered - rejected, "defect_count": rejected,
           "yield_on_ordered": guarded_ratio((ordered - rejected).cast("double"), ordered)}
    if inspected is not None:
        out["defect_rate"] = guarded_ratio(rejected.cast("double"), inspected)
        if passed is not None:
            out["yield_on_inspected"] = guarded_ratio(passed.cast("double"), inspected)
    return out


def split_cost(amount: Column, parts_share: Column, labor_share: Column,
               scale: str = "decimal(20,2)") -> dict[str, Column]:
    """Repeatable cost split (replaces unseeded random draws): shares are row-derived."""
    a = amount.cast("decimal(12,2)")
    return {"parts": (a * parts_share).cast(scale), "labor": (a * labor_share).cast(scale),
            "total": (a * (parts_share + labor_share)).cast(scale)}


def cascade(df: DataFrame, steps: Mapping[str, str | Column]) -> DataFrame:
    """Add columns of which each may read the ones before it, in one projection (lateral column
    aliases): a rate from a total, a status from the rate, a disposition from the status.
    A name that `df` already has would hide the step from the later ones, so it is an error."""
    clash = [c for c in steps if c.lower() in {x.lower() for x in df.columns}]
    if clash:
        raise ValueError(f"steps {clash} are columns already")
    return df.select("*", *[(F.expr(e) if isinstance(e, str) else e).alias(n) for n, e in steps.items()])
