from conftest import rows
from strata.operators import checks as K


def test_orphans_null_key_and_empty_parent(spark):
    child = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, fk int")
    parent = spark.createDataFrame([(10,)], "pk int")
    assert rows(K.orphans(child, parent, "fk", "pk"), "id") == [(2,), (3,)]
    empty = spark.createDataFrame([], "pk int")
    assert K.orphans(child, empty, "fk", "pk").count() == 3


def test_reconcile_missing_extra_equal_counts(spark):
    a = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    b = spark.createDataFrame([(1,), (2,), (4,)], "k int")
    r = K.reconcile(a, b, ["k"]).first()
    assert (r.n_src, r.n_dst, r.n_missing, r.n_extra) == (3, 3, 1, 1)


def test_schema_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert K.schema_gaps(df, ["a", "c"]) == {"missing": ["c"], "unexpected": ["b"]}
    n = K.null_counts(df).first()
    assert (n.a, n.b) == (1, 2)
    res = K.check_row("not_null", "t", "ERROR", K.null_counts(df, ["a"]), col="a")
    assert res.first().status == "FAIL"
    import pytest
    with pytest.raises(K.CheckFailed):
        K.enforce(res)
    with pytest.raises(K.CheckFailed):
        K.require_columns(df, ["zz"])


def test_unmasked_counts_null(spark):
    df = spark.createDataFrame([("ab***",), ("clear",), (None,)], "m string")
    assert K.unmasked_count(df, "m").first().n == 2


def test_fk_violation_record_key_is_child_row_key(spark):
    child = spark.createDataFrame([("INSP-1", "ORD-9"), ("INSP-2", "ORD-1")], "inspection_id string, order_id string")
    parent = spark.createDataFrame([("ORD-1",)], "order_id string")
    v = K.fk_violations(child, parent, "order_id", "order_id", "quality_inspection", "DQ-010",
                        record_key="inspection_id").collect()
    assert [(r.record_key, r.field_name, r.field_value, r.action_taken) for r in v] == \
        [("INSP-1", "order_id", "ORD-9", "WARN")]


def test_consolidate_paths_skips_missing_and_fills_columns(spark, scratch):
    from strata.operators import report
    a, b = scratch("va"), scratch("vb")
    spark.createDataFrame([("x", "R1")], "record_key string, violated_rule_id string").write.parquet(a)
    spark.createDataFrame([("y", "R2", "f")], "record_key string, violated_rule_id string, field_name string") \
        .write.parquet(b)
    u = report.consolidate_paths(spark, [a, scratch("never-written"), b])
    assert rows(u, "record_key", "field_name") == [("x", None), ("y", "f")]
    assert report.consolidate_paths(spark, [scratch("none")]) is None
    rep = report.violation_report(u)
    assert rows(rep) == [("R1", 1), ("R2", 1)]


def test_reconcile_counts_lost_copies_and_null_keys(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    r = K.reconcile(a, b, ["k"]).first()
    assert (r.n_src, r.n_dst, r.n_missing, r.n_extra) == (4, 3, 1, 0)


def test_fk_violation_ids_tell_rows_apart(spark):
    child = spark.createDataFrame([(1, None), (2, None), (3, 9), (4, 9)], "id int, fk int")
    parent = spark.createDataFrame([(1,)], "pk int")
    v = K.fk_violations(child, parent, "fk", "pk", "child", "DQ-010")
    assert v.select("violation_id").distinct().count() == 4
