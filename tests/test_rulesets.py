"""Entity rule sets on rows shaped like the landed sources (hand-written edge rows)."""
import datetime as dt

from pyspark.sql import functions as F

from strata import rulesets
from strata.context import RunContext
from strata.operators import rules as R

T0 = dt.datetime(2026, 2, 1, 10, 0)


def test_telemetry_reasons_in_order(spark):
    df = spark.createDataFrame([
        ("DEV-1", T0, "FAC-NA-001", 70.0, 1.0),
        (None, T0, None, 70.0, 1.0),                 # two failures: first reason wins
        ("DEV-2", None, "FAC-EU-003", 70.0, 1.0),
        ("DEV-3", T0, "FAC-EU-003", 151.0, 1.0),
        ("DEV-4", T0, "FAC-EU-003", -50.0, 100.0),   # both bounds inclusive
        ("DEV-5", T0, "FAC-EU-003", 20.0, None),
    ], "device_id string, event_timestamp timestamp, facility_id string, temperature double, vibration_x double")
    t = R.tag_rules(df, rulesets.telemetry_rules())
    got = {r.device_id: r[R.REASON] for r in t.collect()}
    assert got == {"DEV-1": None, None: "DQ-001", "DEV-2": "DQ-002", "DEV-3": "DQ-004",
                   "DEV-4": None, "DEV-5": "DQ-005"}


def test_inspection_rules_and_rates(spark):
    df = spark.createDataFrame([
        ("INSP-1", "ORD-1", 100, 90, 10, T0),
        ("INSP-2", "ORD-2", 100, 95, 10, T0),        # inconsistent
        ("INSP-3", "ORD-3", 100, -1, 10, T0),        # negative
        ("INSP-4", "ORD-4", 0, 0, 0, T0),            # zero inspected: rates NULL
        ("INSP-5", "ORD-5", 10, 5, 5, None),
    ], "inspection_id string, order_id string, units_inspected int, units_passed int, "
       "units_rejected int, inspection_timestamp timestamp")
    t = R.tag_rules(df.withColumns(rulesets.inspection_derived()), rulesets.inspection_rules())
    got = {r.inspection_id: (r[R.REASON], r.yield_rate) for r in t.collect()}
    assert got["INSP-1"] == (None, 0.9)
    assert got["INSP-2"][0] == "DQ-QI-004" and got["INSP-3"][0] == "DQ-QI-003"
    assert got["INSP-4"] == (None, None) and got["INSP-5"][0] == "DQ-QI-005"


def test_duplicate_orders_and_descriptions(spark):
    df = spark.createDataFrame([("ORD-1", "F", "EQ-1", 1), ("ORD-1", "F", "EQ-1", 2), ("ORD-2", None, "EQ-2", 3)],
                               "order_id string, facility_id string, equipment_id string, seq long")
    c = R.classify(df, rulesets.production_order_rules(), rulesets.ENTITY_KEYS["production_orders"], ["seq"])
    _, bad, dup = R.split(c)
    descs = rulesets.descriptions("production_orders")
    v = R.violations(dup, "production_orders", "order_id", "seq", rule_id="DQ-PO-004",
                     descriptions=descs, ctx=RunContext(run_id="r")).first()
    assert v.violated_rule_desc == "Duplicate order" and dup.first().seq == 1
    assert bad.first()[R.REASON] == "DQ-PO-002"


def test_cleanse_entity(spark):
    df = spark.createDataFrame([
        ("INSP-1", "ORD-1", 100, 90, 10, T0, 1), ("INSP-1", "ORD-1", 100, 91, 9, T0, 2),
        ("INSP-2", None, 10, 5, 5, T0, 3),
    ], "inspection_id string, order_id string, units_inspected int, units_passed int, "
       "units_rejected int, inspection_timestamp timestamp, seq long")
    c, v = rulesets.cleanse("quality_inspection", df, RunContext(run_id="r9"), order=["seq"])
    valid = c.filter(F.col(R.DISPOSITION) == R.VALID).collect()
    assert len(valid) == 1 and valid[0].seq == 2 and valid[0].yield_rate == 0.91
    assert valid[0]._pipeline_run_id == "r9"
    got = sorted((r.violated_rule_id, r.record_key, r.action_taken) for r in v.collect())
    assert got == [("DQ-QI-002", "INSP-2", "QUARANTINE"), ("DQ-QI-006", "INSP-1", "QUARANTINE")]
