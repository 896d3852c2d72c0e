import math

from pyspark.sql import functions as F

from conftest import rows
from strata.context import RunContext
from strata.operators import rules as R

SCHEMA = "id long, dev string, temp double, ts timestamp_ntz"


def _rules():
    return [R.required("dev", "DQ-001", "ok_dev"), R.in_range("temp", -50, 150, "DQ-004", "ok_t")]


def test_tag_rules_null_nan_bounds_and_two_failures(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([
        (1, "a", -50.0, t0),          # lower bound exactly: passes
        (2, "a", 150.0, t0),          # upper bound exactly: passes
        (3, "a", None, t0),           # NULL metric fails
        (4, "a", math.nan, t0),       # NaN fails
        (5, None, 999.0, t0),         # fails two rules, first reason kept
        (6, "b", 150.0001, t0),
    ], SCHEMA)
    out = R.tag_rules(df, _rules())
    got = {r.id: (r[R.PASSED], r[R.REASON], list(r[R.FAILED])) for r in out.collect()}
    assert got[1] == (True, None, [])
    assert got[2] == (True, None, [])
    assert got[3] == (False, "DQ-004", ["DQ-004"])
    assert got[4] == (False, "DQ-004", ["DQ-004"])
    assert got[5] == (False, "DQ-001", ["DQ-001", "DQ-004"])
    assert got[6][0] is False


def test_empty_frame(spark):
    df = spark.createDataFrame([], SCHEMA)
    c = R.classify(df, _rules(), ["dev"], ["ts", "id"])
    assert c.count() == 0
    m = R.metrics(c).first()
    assert (m.n_in, m.n_valid, m.n_bad, m.n_dup) == (0, 0, 0, 0)


def test_classify_balances_and_no_row_escapes(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    data = [(i, None if i % 7 == 0 else f"d{i % 3}", float(i % 200), t0 + dt.timedelta(minutes=i % 5))
            for i in range(300)]
    df = spark.createDataFrame(data, SCHEMA)
    c = R.classify(df, _rules(), ["dev"], ["ts", "id"])
    m = R.metrics(c).first()
    assert m.n_in == 300 == m.n_valid + m.n_bad + m.n_dup
    assert c.filter(F.col(R.DISPOSITION).isNull()).count() == 0
    # exactly one valid row per key among passing rows
    per_key = c.filter(F.col(R.DISPOSITION) == R.VALID).groupBy("dev").count()
    assert {r["count"] for r in per_key.collect()} == {1}


def test_violation_ids_repeatable_and_null_key(spark):
    df = spark.createDataFrame([(1, None, 1.0, None)], SCHEMA)
    bad = R.tag_rules(df, _rules())
    a = R.violations(bad, "t", "dev", "id", ctx=RunContext(run_id="r1")).first()
    b = R.violations(bad, "t", "dev", "id", ctx=RunContext(run_id="r2")).first()
    assert a.violation_id == b.violation_id and a.violation_id is not None
    assert a.record_key is None and a.violated_rule_id == "DQ-001"


def test_violation_payload_keeps_row(spark):
    df = spark.createDataFrame([(7, None, 1.0, None)], SCHEMA)
    v = R.violations(R.tag_rules(df, _rules()), "t", "dev", "id", payload=True).first()
    assert '"id":7' in v.payload


def test_write_classified_observes_counts_in_the_write(spark, scratch):
    from strata.plans import quality
    c = quality.classified(spark, "/root/testdata/sf0.001")
    p = scratch("silver")
    m = R.write_classified(c, p, RunContext(run_id="r1"))
    expect = R.metrics(c).first().asDict()
    assert m == expect
    back = spark.read.parquet(p)
    assert back.count() == m["n_in"]
    assert back.filter(F.col(R.DISPOSITION) == R.VALID).count() == m["n_valid"]
