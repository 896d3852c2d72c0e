"""One regression test per defect decision."""
import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from strata import schemas
from strata.context import RunContext
from strata.functions.expressions import guarded_ratio, mask_prefix
from strata.operators import changes as C
from strata.operators import checks as K
from strata.operators import dedup, governance, history, keys, model
from strata.operators import rules as R
from strata.sources import readers, writers
from strata.streaming import ingest

T0 = dt.datetime(2024, 1, 1)
CHG = "k string, value double, ts timestamp_ntz, lsn long, op string"
TGT = "k string, value double, ts timestamp_ntz, lsn long, is_deleted boolean"


def test_d01_total_order_makes_winner_deterministic(spark):
    df = spark.createDataFrame([("a", T0, i) for i in range(20)], "k string, ts timestamp_ntz, id long")
    w1, _ = dedup.latest(df, ["k"], ["ts", "id"])
    w2, _ = dedup.latest(df.repartition(7), ["k"], ["ts", "id"])
    assert rows(w1) == rows(w2) == [("a", T0, 19)]


def test_d02_lsn_breaks_timestamp_ties(spark):
    log = spark.createDataFrame([("a", 1.0, T0, 1, "INSERT"), ("a", 2.0, T0, 2, "UPDATE")], CHG)
    latest, _ = C.latest_changes(log, ["k"])
    assert latest.first().value == 2.0


def test_d03_all_columns_reinsert_and_stale(spark):
    tgt = spark.createDataFrame([("a", 1.0, T0, 5, True)], TGT).withColumn("tech", F.lit("t1"))
    chg = spark.createDataFrame([("a", 2.0, T0 + dt.timedelta(1), 6, "INSERT")], CHG).withColumn("tech", F.lit("t2"))
    out = C.apply_changes(tgt, chg, ["k"]).first()        # default: every non-key column
    assert (out.value, out.tech, out.is_deleted) == (2.0, "t2", False)
    stale = spark.createDataFrame([("a", 9.0, T0, 4, "UPDATE")], CHG).withColumn("tech", F.lit("old"))
    assert C.apply_changes(tgt, stale, ["k"]).first().value == 1.0


def test_d04_superseded_is_history_with_info_action(spark):
    log = spark.createDataFrame([("a", 1.0, T0, 1, "INSERT"), ("a", 2.0, T0, 2, "UPDATE")], CHG)
    _, sup = C.latest_changes(log, ["k"])
    v = R.violations(sup, "maint", "k", "lsn", rule_id="DQ-MR-002", action=R.INFO).first()
    assert v.action_taken == "INFO"


def _snap(spark, data):
    return spark.createDataFrame(data, "k int, a string, b string")


def test_d05_changed_twice_is_seen_twice(spark):
    d = [dt.date(2026, m, 1) for m in (1, 2, 3)]
    t = history.apply(None, _snap(spark, [(1, "x", "1")]), ["k"], ["a", "b"], d[0])
    t = history.apply(t, _snap(spark, [(1, "x", "2")]), ["k"], ["a", "b"], d[1])
    t = history.apply(t, _snap(spark, [(1, "x", "3")]), ["k"], ["a", "b"], d[2])
    assert t.count() == 3 and t.filter(F.col(history.HASH).isNull()).count() == 0


def test_d06_null_position_matters(spark):
    t = history.apply(None, _snap(spark, [(1, None, "a")]), ["k"], ["a", "b"], dt.date(2026, 1, 1))
    assert history.detect(t, _snap(spark, [(1, "a", None)]), ["k"], ["a", "b"])[1].count() == 1


def test_d07_duplicate_source_keys_reduced(spark):
    src = spark.createDataFrame([(1, "a", "b", 1), (1, "c", "d", 2)], "k int, a string, b string, s int")
    t = history.apply(None, src, ["k"], ["a", "b"], dt.date(2026, 1, 1), attrs=["a", "b"], source_order=["s"])
    assert t.count() == 1


def _versions(spark):
    return spark.createDataFrame([(1, 1, dt.date(2020, 1, 1), dt.date(2021, 1, 1)),
                                  (1, 2, dt.date(2021, 1, 1), None)], "dk int, v int, st date, en date")


def test_d08_change_day_matches_one_version(spark):
    f = spark.createDataFrame([(1, dt.date(2021, 1, 1))], "fk int, d date")
    assert model.temporal_join(f, _versions(spark), "fk", "dk", "d", "st", "en").count() == 1


def test_d09_first_version_starts_far_past(spark):
    t = history.apply(None, _snap(spark, [(1, "a", "b")]), ["k"], ["a", "b"], dt.date(2026, 1, 1))
    assert t.first()[history.START] == history.INITIAL_START


def test_d10_grain_check_catches_multiplication(spark):
    f = spark.createDataFrame([(7, 1, dt.date(2021, 1, 1))], "id int, fk int, d date")
    j = model.temporal_join(f, _versions(spark), "fk", "dk", "d", "st", "en", half_open=False)
    assert model.grain_violations(j, ["id"]).count() == 1


def test_d11_unknown_member(spark):
    f = spark.createDataFrame([(1, "zz")], "id int, nk string")
    d = spark.createDataFrame([("a", 5)], "nk2 string, sk long")
    assert model.lookup_keys(f, d, "nk", "nk2", "sk").first().sk == model.UNKNOWN_SK


def test_d12_cost_split_repeatable(spark):
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    c = model.split_cost(F.col("value"), F.col("event_id") % 100, (F.col("event_id") * 3) % 100)
    a = rows(e.select("event_id", c["total"].alias("t")))
    b = rows(e.select("event_id", c["total"].alias("t")))
    assert a == b


def test_d13_guarded_ratio(spark):
    r = spark.createDataFrame([(5.0, 0), (5.0, 2)], "a double, n int").select(guarded_ratio("a", "n").alias("r"))
    assert rows(r) == [(2.5,), (None,)]


def test_d14_keys_stable_across_loads(spark):
    k1 = keys.assign_keys(spark.createDataFrame([("b",), ("a",)], "nk string"), ["nk"], "sk")
    k2 = keys.assign_keys(spark.createDataFrame([("a",), ("0",), ("b",)], "nk string"), ["nk"], "sk", k1)
    assert dict(rows(k2)) == {"a": 1, "b": 2, "0": 3}


def test_d15_rerun_does_not_double(spark, scratch):
    p = scratch("d15")
    writers.write_run(spark.range(5), p, "r")
    writers.write_run(spark.range(5), p, "r")
    assert spark.read.parquet(p).count() == 5


def test_d16_drain_is_awaited(spark, scratch):
    land, sink, ck = scratch("l"), scratch("s"), scratch("c")
    spark.range(50).selectExpr("id", "cast(id as double) as v").write.json(land)
    ingest.drain(ingest.file_stream(spark, land, "id long, v double"), sink, ck)
    assert spark.read.parquet(sink).count() == 50        # complete when drain returns


def test_d17_one_run_context_everywhere(spark):
    ctx = RunContext(run_id="r-17")
    df = spark.createDataFrame([(1, None)], "id int, dev string")
    tagged = R.tag_rules(R.stamp(df, ctx), [R.required("dev", "DQ-001")])
    v = R.violations(tagged, "t", "dev", "id", ctx=ctx).first()
    s = tagged.first()
    assert v.pipeline_run_id == s._pipeline_run_id == "r-17"
    assert v.detected_at == s._processed_timestamp


def test_d18_unmapped_principal_sees_nothing(spark):
    ent = spark.createDataFrame([("u", "EU")], "principal string, scope_value string")
    df = spark.createDataFrame([(1, "EU")], "id int, fac string")
    assert governance.row_scope(df, "fac", ent, "nobody").count() == 0


def test_d19_mask_keep_and_null(spark):
    df = spark.createDataFrame([("TECH-1",), ("TECH-2",), (None,)], "t string")
    m = df.select(mask_prefix("t", 6).alias("m"))
    assert sorted(r.m for r in m.collect() if r.m) == ["TECH-1***", "TECH-2***"]
    assert K.unmasked_count(m, "m", null_ok=True).first().n == 0


def test_d20_format_aware_counts(spark, scratch):
    src = spark.read.parquet(f"{SF_SMALL}/supplier.parquet")
    p_csv, p_pq = scratch("csv"), scratch("pq")
    src.write.option("header", "true").csv(p_csv)
    src.write.parquet(p_pq)
    back_csv = readers.read_csv(spark, p_csv, src.schema)
    back_pq = readers.read(spark, p_pq, "parquet")
    for back in (back_csv, back_pq):
        r = K.reconcile(src, back, ["s_suppkey"]).first()
        assert (r.n_missing, r.n_extra, r.n_src - r.n_dst) == (0, 0, 0)


def test_d21_anomaly_columns_typed_null(spark):
    f = writers.conform(spark.createDataFrame([(1,)], "equipment_sk long"), schemas.FACT_SENSOR_READINGS)
    r = f.first()
    assert r.anomaly_score is None and dict(f.dtypes)["anomaly_score"] == "double"


def test_d22_all_failed_ids_and_locator(spark):
    df = spark.createDataFrame([(1, None, None)], "id int, a string, b string")
    t = R.tag_rules(df, [R.required("a", "A"), R.required("b", "B")])
    r = t.first()
    assert list(r[R.FAILED]) == ["A", "B"] and r[R.REASON] == "A"
    assert R.violations(t, "x", "a", "id").first().violation_id is not None


def test_d23_payload_allows_repair(spark):
    df = spark.createDataFrame([(1, None)], "id int, a string")
    v = R.violations(R.tag_rules(df, [R.required("a", "A")]), "x", "a", "id", payload=True).first()
    assert v.payload.startswith("{") and '"id":1' in v.payload


def test_d24_one_fk_function_for_every_table(spark):
    child = spark.createDataFrame([(1, 9)], "id int, fk int")
    parent = spark.createDataFrame([(1,)], "pk int")
    v = K.fk_violations(child, parent, "fk", "pk", "child", "DQ-010").first()
    assert (v.action_taken, v.field_name, v.field_value) == ("WARN", "fk", "9")


def test_d19_deleted_rows_hidden_by_option(spark):
    df = spark.createDataFrame([(1, "TECH-1", False), (2, "TECH-2", True)], "id int, t string, is_deleted boolean")
    v = governance.governed_view(df, {"t": lambda c: mask_prefix(c, 4)})
    assert rows(v, "id", "t") == [(1, "TECH***")]
    assert governance.governed_view(df, include_deleted=True).count() == 2


def test_d22_row_hash_locator_when_no_key(spark):
    df = spark.createDataFrame([(None, "x"), (None, "y")], "a string, b string")
    t = R.tag_rules(df, [R.required("a", "A")])
    ids = [r.violation_id for r in R.violations(t, "x", "a").collect()]
    assert len(set(ids)) == 2 and all(ids)
