"""Declarative data-quality rules: tag, classify, and turn failures into violation records.

A rule is data (`Rule`), not table-specific code. `tag_rules` adds one boolean per rule
in a single projection; every flag is coalesced to false, so a NULL comparison can
never let a row escape both the valid and the quarantined branch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.hashing import stable_id
from .dedup import mark_latest, winners

PASSED = "_dq_passed"
REASON = "_violation_reason"
FAILED = "_failed_rules"
LATEST = "_is_latest"
DISPOSITION = "_disposition"

# Dispositions and actions of violation records.
VALID, QUARANTINED, DUPLICATE = "valid", "quarantined", "duplicate"
QUARANTINE, WARN, INFO = "QUARANTINE", "WARN", "INFO"


@dataclass(frozen=True)
class Rule:
    """`predicate` is True when the row passes. `flag` names the boolean column."""

    rule_id: str
    predicate: Column
    flag: str | None = None
    description: str = ""
    field: str | None = None
    action: str = QUARANTINE

    @property
    def flag_name(self) -> str:
        return self.flag or "dq_" + self.rule_id.lower().replace("-", "_")


def required(column: str, rule_id: str, flag: str | None = None, description: str = "") -> Rule:
    return Rule(rule_id, F.col(column).isNotNull(), flag, description or f"{column} NULL", column)


def in_range(column: str, lo, hi, rule_id: str, flag: str | None = None,
             description: str = "") -> Rule:
    """Closed range; NULL and NaN fail."""
    c = F.col(column)
    return Rule(rule_id, c.isNotNull() & ~F.isnan(c.cast("double")) & c.between(lo, hi), flag,
                description or f"{column} invalid", column)


def non_negative(columns: Sequence[str], rule_id: str, flag: str | None = None,
                 description: str = "") -> Rule:
    pred = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & (F.col(c) >= 0) for c in columns])
    return Rule(rule_id, pred, flag, description or "negative value")


def tag_rules(df: DataFrame, rules: Sequence[Rule], passed: str = PASSED, reason: str = REASON,
              failed: str | None = FAILED) -> DataFrame:
    """One flag per rule, their conjunction, the first failing rule id and all failing ids."""
    flags = {r.flag_name: F.coalesce(r.predicate, F.lit(False)) for r in rules}
    out = df.withColumns(flags)
    conj = reduce(lambda a, b: a & b, [F.col(r.flag_name) for r in rules], F.lit(True))
    first = None
    for r in rules:
        cond = ~F.col(r.flag_name)
        first = F.when(cond, F.lit(r.rule_id)) if first is None else first.when(cond, F.lit(r.rule_id))
    cols = {passed: conj, reason: first if first is not None else F.lit(None).cast("string")}
    if failed:
        cols[failed] = F.array_compact(F.array(*[F.when(~F.col(r.flag_name), F.lit(r.rule_id))
                                                 for r in rules]))
    return out.withColumns(cols)


def failed_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Tagged rows that fail a rule: a filter, no shuffle."""
    return tag_rules(df, rules).filter(~F.col(PASSED))


def valid_rows(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The latest passing row per key: one scan, one shuffle."""
    return winners(tag_rules(df, rules).filter(F.col(PASSED)), keys, order)


def balance(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str]) -> DataFrame:
    """`metrics` without ranking: valid rows are the distinct keys of passing rows, counted by
    partial aggregation (n_in = n_valid + n_bad + n_dup)."""
    tagged = tag_rules(df, rules)
    ok = F.col(PASSED)
    group = [ok.alias("__ok"), *[F.when(ok, F.col(k)).alias(f"__k{i}") for i, k in enumerate(keys)]]
    per_key = tagged.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"))
    total = lambda c, v: F.coalesce(F.sum(F.when(c, v)), F.lit(0)).cast("bigint")
    good, n = F.col("__ok"), F.col("__n")
    return per_key.agg(F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("n_in"),
                       total(good, F.lit(1)).alias("n_valid"), total(~good, n).alias("n_bad"),
                       total(good, n - 1).alias("n_dup"))


def classify(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Tag rules, then keep the latest passing row per key: one frame, one `_disposition`.

    valid = passed and latest; duplicate = passed but superseded; quarantined = failed.
    Writing this single classified frame (partitioned by disposition) replaces the
    six separate recomputations of the original notebook.
    """
    tagged = tag_rules(df, rules)
    marked = mark_latest(tagged, keys, order, flag=LATEST, where=F.col(PASSED))
    disp = (F.when(~F.col(PASSED), F.lit(QUARANTINED))
            .when(F.col(LATEST), F.lit(VALID)).otherwise(F.lit(DUPLICATE)))
    return marked.withColumn(DISPOSITION, disp)


def split(classified: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    d = F.col(DISPOSITION)
    return (classified.filter(d == VALID), classified.filter(d == QUARANTINED),
            classified.filter(d == DUPLICATE))


def violations(failed: DataFrame, source_table: str, record_key: str | Column,
               locator: str | Column | None = None, rule_id: str | Column | None = None,
               descriptions: dict[str, str] | None = None, action: str | Column = QUARANTINE,
               ctx: RunContext | None = None, field_name: str | Column | None = None,
               field_value: str | Column | None = None, payload: bool = False) -> DataFrame:
    """Violation records in the fixed shape (see FIXTURES.md §2).

    The id is a hash of (table, row locator, rule): repeatable, unlike a per-run uuid,
    and well defined even when the record key itself is NULL. Without a `locator`
    column the locator is a hash of the whole row.
    """
    as_col = (lambda c: F.col(c) if isinstance(c, str) else c)
    rid = F.col(REASON) if rule_id is None else F.lit(rule_id) if isinstance(rule_id, str) else rule_id
    desc = F.lit(None).cast("string")
    if descriptions:
        desc = F.try_element_at(F.create_map(*[F.lit(x) for kv in descriptions.items() for x in kv]), rid)
    ctx = ctx or RunContext(run_id="unset")
    loc = as_col(locator) if locator is not None else \
        F.sha2(F.to_json(F.struct(*[F.col(c) for c in failed.columns])), 256)
    cols = [
        stable_id(F.lit(source_table), loc, rid).alias("violation_id"),
        F.lit(source_table).alias("source_table"),
        as_col(record_key).cast("string").alias("record_key"),
        rid.alias("violated_rule_id"),
        desc.alias("violated_rule_desc"),
        (F.lit(None) if field_name is None else F.lit(field_name) if isinstance(field_name, str)
         else field_name).cast("string").alias("field_name"),
        (F.lit(None) if field_value is None else as_col(field_value)).cast("string").alias("field_value"),
        (F.lit(action) if isinstance(action, str) else action).alias("action_taken"),
        F.lit(ctx.as_of).cast("timestamp").alias("detected_at"),
        F.lit(ctx.run_id).alias("pipeline_run_id"),
    ]
    if payload:
        cols.append(F.to_json(F.struct(*[F.col(c) for c in failed.columns])).alias("payload"))
    return failed.select(*cols)


def violation_rule(duplicate_rule_id: str) -> Column:
    """Rule id of a non-valid classified row: its first failed rule, or the duplicate rule."""
    return F.when(F.col(DISPOSITION) == QUARANTINED, F.col(REASON)).otherwise(F.lit(duplicate_rule_id))


def all_violations(classified: DataFrame, source_table: str, record_key: str | Column,
                   duplicate_rule_id: str, locator: str | Column | None = None,
                   descriptions: dict[str, str] | None = None, ctx: RunContext | None = None,
                   duplicate_action: str = QUARANTINE) -> DataFrame:
    """Violation records for every non-valid row of a classified frame, in one pass. Failures are
    quarantined; duplicates carry `duplicate_action` (superseded history is INFO)."""
    bad = classified.filter(F.col(DISPOSITION) != VALID)
    action = F.when(F.col(DISPOSITION) == QUARANTINED, F.lit(QUARANTINE)).otherwise(F.lit(duplicate_action))
    return violations(bad, source_table, record_key, locator, rule_id=violation_rule(duplicate_rule_id),
                      descriptions=descriptions, ctx=ctx, action=action)


def stamp(df: DataFrame, ctx: RunContext) -> DataFrame:
    """Run stamp: `_pipeline_run_id`, `_processed_timestamp` bound once per run."""
    return df.withColumns({"_pipeline_run_id": F.lit(ctx.run_id),
                           "_processed_timestamp": F.lit(ctx.as_of).cast("timestamp")})


def metrics(classified: DataFrame) -> DataFrame:
    """Balance metrics in one pass: n_in = n_valid + n_bad + n_dup."""
    d = F.col(DISPOSITION)
    return classified.agg(
        F.count(F.lit(1)).alias("n_in"),
        F.count_if(d == VALID).alias("n_valid"),
        F.count_if(d == QUARANTINED).alias("n_bad"),
        F.count_if(d == DUPLICATE).alias("n_dup"),
    )


def write_classified(classified: DataFrame, path: str, ctx: RunContext, fmt: str = "parquet",
                     partition_by: Sequence[str] = ()) -> dict:
    """One write of the classified frame, partitioned by run and disposition; the balance
    counts ride on that same job through an `Observation` (no extra count jobs, and no
    chance that counts and written rows come from different evaluations)."""
    from pyspark.sql import Observation

    from ..sources.writers import write_run
    obs = Observation(f"classified-{ctx.run_id}")
    d = F.col(DISPOSITION)
    observed = classified.observe(
        obs, F.count(F.lit(1)).alias("n_in"), F.count_if(d == VALID).alias("n_valid"),
        F.count_if(d == QUARANTINED).alias("n_bad"), F.count_if(d == DUPLICATE).alias("n_dup"))
    write_run(observed, path, ctx.run_id, fmt=fmt, partition_by=[DISPOSITION, *partition_by])
    return obs.get
