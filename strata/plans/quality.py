"""Data-quality proofs on the telemetry stand-in (events)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.expressions import case_map, guarded_ratio, threshold_ladder
from ..operators import checks, model, report, rules, widen
from ..operators.rules import Rule, in_range, required
from ..sources.readers import RESCUED
from .fixtures import NULL_TECHNICIAN_EVERY, telemetry
from .tables import Tables

# Telemetry rule ids, flags and range bounds of the proofs.
TELEMETRY_RULES = (
    ("DQ-001", "ok_dev", "device_id NULL"),
    ("DQ-003", "ok_fac", "facility_id NULL"),
    ("DQ-004", "ok_rng", "value invalid"),
)
VALUE_MIN, VALUE_MAX = 0, 150
DUPLICATE_RULE = "DQ-006"
KEYS = ("device_id", "facility_id", "event_date")
ORDER = ("ts", "event_id")
RUN = RunContext(run_id="run-1")


def telemetry_rules() -> list[Rule]:
    (r1, f1, d1), (r2, f2, d2), (r3, f3, d3) = TELEMETRY_RULES
    return [required("device_id", r1, f1, d1), required("facility_id", r2, f2, d2),
            in_range("value", VALUE_MIN, VALUE_MAX, r3, f3, d3)]


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry(Tables(spark, sf_dir).events).withColumn("event_date", F.to_date("ts"))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.classify(_raw(spark, sf_dir), telemetry_rules(), KEYS, ORDER)


def dq_tag(spark, sf_dir):
    raw = telemetry(Tables(spark, sf_dir).events)
    t = rules.tag_rules(raw, telemetry_rules())
    return t.select("event_id", "ok_dev", "ok_fac", "ok_rng",
                    F.col(rules.PASSED).alias("passed"), F.col(rules.REASON).alias("reason"))


def dq_valid_dedup(spark, sf_dir):
    valid = rules.valid_rows(_raw(spark, sf_dir), telemetry_rules(), KEYS, ORDER)
    return valid.select("event_id", "device_id", "facility_id", "event_date", "value")


def dq_quarantine(spark, sf_dir):
    bad = rules.failed_rows(_raw(spark, sf_dir), telemetry_rules())
    v_bad = rules.violations(bad, "events", "device_id", "event_id",
                             descriptions={r: d for r, _, d in TELEMETRY_RULES}, ctx=RUN)
    return v_bad.select("violation_id", "source_table", "record_key",
                        F.col("violated_rule_id").alias("reason"), "action_taken")


def dq_all_violations(spark, sf_dir):
    """Failures and duplicates in one pass over the classified frame (no union of two
    re-evaluations of the same plan)."""
    c = classified(spark, sf_dir)
    return c.filter(F.col(rules.DISPOSITION) != rules.VALID).select(
        "event_id", rules.violation_rule(DUPLICATE_RULE).alias("reason"))


def dq_metrics(spark, sf_dir):
    return rules.balance(_raw(spark, sf_dir), telemetry_rules(), KEYS)


def dq_exact_copies(spark, sf_dir):
    """Every event delivered twice: of copies equal in all columns exactly one is valid."""
    raw = _raw(spark, sf_dir)
    twice = rules.classify(raw.unionByName(raw), telemetry_rules(), KEYS, ORDER)
    return twice.groupBy("event_id").agg(
        *[F.count_if(F.col(rules.DISPOSITION) == d).alias(f"n_{d}")
          for d in (rules.VALID, rules.DUPLICATE, rules.QUARANTINED)])


def dq_all_failed_rules(spark, sf_dir):
    bad = rules.failed_rows(_raw(spark, sf_dir), telemetry_rules())
    return bad.select("event_id", F.concat_ws(",", rules.FAILED).alias("failed_rules"))


def dq_report(spark, sf_dir):
    v = dq_all_violations(spark, sf_dir)
    return report.violation_report(v, by=["reason"])


def audit_log(spark, sf_dir):
    m = rules.balance(_raw(spark, sf_dir), telemetry_rules(), KEYS)
    a = report.audit_rows(m, RUN, target_table="events", action="WRITE")
    return a.select("target_table", "action_type", "n_rows", F.col("pipeline_run_id").alias("run_id"))


def dq_cross_column(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    pred = ((F.col("l_quantity") >= 0)
            & (F.col("l_discount").cast("decimal(5,2)") + F.col("l_tax").cast("decimal(5,2)")
               <= F.lit(0.12).cast("decimal(5,2)")))
    rule = Rule("DQ-QI-005", pred, flag="consistent")
    t = rules.tag_rules(li, [rule], failed=None)
    return t.select("l_orderkey", "l_linenumber", "l_partkey", "consistent")


def derived_rates(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    den = F.floor("o_totalprice").cast("bigint") % 5
    return o.select("o_orderkey", guarded_ratio(F.col("o_totalprice"), den).alias("rate"))


def fk_orphans(spark, sf_dir):
    t = Tables(spark, sf_dir)
    v = checks.fk_violations(t.orders, t.lineitem, "o_orderkey", "l_orderkey", "orders", "DQ-010",
                             locator="o_orderkey", ctx=RUN)
    return v.select(F.col("record_key").cast("bigint").alias("o_orderkey"), "violated_rule_id",
                    "field_value", "action_taken")


def fk_null_keys(spark, sf_dir):
    """Orphans with a NULL key: each child row has a violation id of its own."""
    t = Tables(spark, sf_dir)
    child = t.events.withColumn("user_id", F.when(F.col("user_id") % NULL_TECHNICIAN_EVERY != 0, F.col("user_id")))
    v = checks.fk_violations(child, t.customer, "user_id", "c_custkey", "events", "DQ-010", record_key="event_id", ctx=RUN)
    return v.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("violation_id").alias("n_ids"),
                 F.count_if(F.col("field_value").isNull()).alias("n_null"))


def union_missing_cols(spark, sf_dir):
    t = Tables(spark, sf_dir)
    high = t.events.filter(F.col("value") > 300).select(
        F.col("event_id").alias("id"), F.col("event_type").alias("reason"))
    orph = checks.orphans(t.orders, t.lineitem, "o_orderkey", "l_orderkey").select(
        F.col("o_orderkey").alias("id"), F.lit("FK").alias("reason"),
        F.lit("o_orderkey").alias("field_name"))
    return report.union_all([high, orph])


# Facility code per bucket and the priority ladder of the proof.
FACILITY_OF_BUCKET = {0: "A", 1: "B", 2: "C"}
FACILITY_DEFAULT = "D"
PRIORITY_LADDER = ((20, "HIGH"), (76, "MEDIUM"))
PRIORITY_DEFAULT = "LOW"


def bucket_case(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    k = F.col("c_custkey")
    return c.select("c_custkey",
                    case_map(k % 4, FACILITY_OF_BUCKET, FACILITY_DEFAULT).alias("fac"),
                    threshold_ladder((k * 37) % 100, PRIORITY_LADDER, PRIORITY_DEFAULT).alias("pri"))


def silver_balance(spark, sf_dir):
    """The single classified write (partitioned by run and disposition, counts observed on
    the same job), read back: rows per disposition."""
    from ..session import scratch_path
    path = scratch_path(spark, "silver")
    rules.write_classified(classified(spark, sf_dir), path, RUN)
    back = spark.read.parquet(path)
    return back.groupBy(rules.DISPOSITION).agg(F.count(F.lit(1)).alias("n"))


# Fixed value: orders of this priority name their customer by a text that is no number.
TEXT_KEY_PRIORITY = "1-URGENT"


def union_widened(spark, sf_dir):
    """Columns of one name with other types: int and decimal, bigint and text (partly no number)."""
    t = Tables(spark, sf_dir)
    lines = t.lineitem.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("number"),
                              F.col("l_suppkey").alias("who"), F.to_date("l_shipdate").alias("day"))
    who = F.when(F.col("o_orderpriority") == TEXT_KEY_PRIORITY, F.concat(F.lit("C-"), F.col("o_custkey").cast("string")))
    orders = t.orders.select(F.col("o_orderkey").cast("int").alias("id"),
                             F.col("o_custkey").cast("decimal(12,1)").alias("number"),
                             F.coalesce(who, F.col("o_custkey").cast("string")).alias("who"), "o_orderstatus")
    return widen.union_widened([lines, orders]).select(
        "id", F.col("number").cast("double").alias("number"), "who", "day", "o_orderstatus",
        F.col(RESCUED)["who"].alias("who_text"))


# The levels of the status cascade.
CASCADE = {
    "units_inspected": "cast(l_quantity as int)",
    "units_rejected": "cast(round(l_discount * 100) as int)",
    "units_passed": "greatest(units_inspected - units_rejected, 0)",
    "defect_rate": "case when units_inspected > 0 then units_rejected / units_inspected end",
    "status": "case when defect_rate = 0 then 'PASS' when defect_rate < 0.2 then 'CONDITIONAL' "
              "when defect_rate is not null then 'FAIL' end",
    "severity": "case when status = 'CONDITIONAL' then 'MINOR' when status = 'FAIL' and defect_rate < 0.5 then 'MAJOR' "
                "when status = 'FAIL' then 'CRITICAL' end",
    "disposition": "case severity when 'MINOR' then 'REWORK' when 'MAJOR' then 'REWORK' when 'CRITICAL' then 'SCRAP' end",
}


def status_cascade(spark, sf_dir):
    """Each level reads the one before it, in one projection; where nothing was rejected, severity
    and disposition stay NULL."""
    li = Tables(spark, sf_dir).lineitem
    return model.cascade(li, CASCADE).select("l_orderkey", "l_linenumber", *CASCADE)
