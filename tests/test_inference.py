"""Inferred and declared schemas: types from a sample, misfits from every row."""
from pyspark.sql import types as T

from conftest import rows
from strata.sources import inference, readers


def _land(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


def _report(spark, path, declared, ratio=1.0):
    return {r.field: r for r in inference.drift_report(spark, path, T._parse_datatype_string(declared), ratio).collect()}


def test_verdicts(spark, scratch):
    p = scratch("j")
    _land(spark, p, ['{"a": 1, "b": 2, "c": "2024-01-01", "d": "x", "e f": true}', '{"a": 2, "b": 2.5, "c": "soon", "d": null}', "{no json"])
    got = _report(spark, p, "a bigint, b bigint, c date, d int, gone double")
    assert {k: (r.verdict, r.proposed, r.n_values, r.n_misfits) for k, r in got.items()} == {
        "a": ("same", "bigint", 2, 0), "b": ("misfits", "double", 2, 1), "c": ("misfits", "string", 2, 1),
        "d": ("misfits", "string", 1, 1), "e f": ("undeclared", "boolean", 1, 0), "gone": ("absent", "double", 0, 0)}


def test_fits_when_every_value_can_be_held(spark, scratch):
    p = scratch("j")
    _land(spark, p, ['{"a": 1, "t": "2024-01-01 10:00:00", "n": {"x": 1}}'])
    got = _report(spark, p, "a smallint, t timestamp, n string")
    assert {k: r.verdict for k, r in got.items()} == {"a": "fits", "t": "fits", "n": "fits"}


def test_field_that_the_sample_missed(spark, scratch):
    p = scratch("j")
    _land(spark, p, ['{"a": 1}'] * 400 + ['{"a": "z", "rare": 3}'])
    got = _report(spark, p, "a bigint", 0.01)
    assert (got["a"].verdict, got["a"].n_misfits, got["a"].n_values) == ("misfits", 1, 401)
    assert got["rare"].verdict == "undeclared" and got["rare"].n_values == 1


def test_reconciled_schema_reads_every_value(spark, scratch):
    p = scratch("j")
    _land(spark, p, ['{"a": 1, "b": 2, "x y": "q"}', '{"a": 2, "b": 2.5}'])
    schema = inference.reconciled(inference.drift_report(spark, p, T._parse_datatype_string("a int, b bigint"), 1.0))
    assert schema == T._parse_datatype_string("a int, b double, `x y` string")
    back = readers.read_json_rescued(spark, p, schema)
    assert rows(back, "a", "b") == [(1, 2.0), (2, 2.5)] and back.where(f"{readers.RESCUED} is not null").isEmpty()


def test_empty_landing(spark, scratch):
    p = scratch("j")
    spark.createDataFrame([], "value string").write.text(p)
    got = _report(spark, p, "a bigint")
    assert got["a"].verdict == "absent" and len(got) == 1
