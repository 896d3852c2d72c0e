"""Widening union, required columns and the status cascade."""
import pytest

from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T
from strata.operators import model, widen
from strata.sources import readers, writers


def test_types_meet_and_misfits_are_rescued(spark):
    a = spark.createDataFrame([(1, 10, 1.5)], "id int, code bigint, x float")
    b = spark.createDataFrame([(2, "20", 2.25), (3, "n/a", None), (4, None, 1.0)], "id bigint, code string, x double")
    got = widen.union_widened([a, b])
    assert dict(got.dtypes) == {"id": "bigint", "code": "bigint", "x": "double", readers.RESCUED: "map<string,string>"}
    assert rows(got) == rows(spark.createDataFrame(
        [(1, 10, 1.5, None), (2, 20, 2.25, None), (3, None, None, {"code": "n/a"}), (4, None, 1.0, None)], got.schema))


def test_no_common_type_is_text_and_old_rescues_stay(spark):
    a = spark.createDataFrame([(1, [1, 2], {"z": "9", "k": "old"})], "id int, v array<int>, _rescued_data map<string,string>")
    b = spark.createDataFrame([(2, True)], "id int, v boolean")
    got = widen.union_widened([a, b])
    assert rows(got.select("id", "v")) == [(1, "[1,2]"), (2, "true")]
    assert got.where("id = 1").first()[readers.RESCUED] == {"z": "9", "k": "old"}
    c = spark.createDataFrame([(3, "x", {"id": "0", "k": "old"})], "id int, k string, _rescued_data map<string,string>")
    d = spark.createDataFrame([(4, 7)], "id int, k int")
    assert widen.union_widened([c, d]).where("id = 3").first()[readers.RESCUED] == {"id": "0", "k": "x"}


def test_absent_columns_empty_frames_and_none(spark):
    a, b = spark.createDataFrame([], "id int"), spark.createDataFrame([(1, "x")], "id bigint, w string")
    assert rows(widen.union_widened([a, b]).select("id", "w")) == [(1, "x")]
    assert widen.common_type(spark, [T.IntegerType(), T.DecimalType(12, 2)]) == T.DecimalType(12, 2)
    with pytest.raises(ValueError):
        widen.union_widened([])


def test_a_null_fails_the_write_and_leaves_no_rows(spark, scratch):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    path = scratch("required")
    with pytest.raises(Exception, match="t.name must not be NULL"):
        writers.write_required(df, path, ["id", "name"], table="t")
    writers.write_required(df.where("id = 1"), path, ["id", "name"], table="t")
    assert rows(spark.read.parquet(path)) == [(1, "a")]
    with pytest.raises(ValueError, match="lacks"):
        writers.enforce_required(df, ["absent"])


def test_quarantine_names_the_null_columns(spark, scratch):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, None)], "id int, name string")
    good, bad = scratch("good"), scratch("bad")
    writers.write_required(df, good, ["id", "name"], quarantine=bad)
    assert rows(spark.read.parquet(good)) == [(1, "a")]
    assert rows(spark.read.parquet(bad), "id", "_null_columns") == [(2, "name"), (None, "id,name")]


def test_cascade_reads_earlier_levels_in_one_projection(spark):
    df = spark.createDataFrame([(10, 0), (10, 5), (0, 0), (None, 1)], "made int, bad int")
    out = model.cascade(df, {"rate": "case when made > 0 then bad / made end", "status": F.expr("if(rate = 0, 'PASS', 'FAIL')"),
                             "level": "case when status = 'FAIL' and rate > 0 then 'MAJOR' end"})
    assert rows(out, "rate", "status", "level") == rows(spark.createDataFrame(
        [(0.0, "PASS", None), (0.5, "FAIL", "MAJOR"), (None, "FAIL", None), (None, "FAIL", None)],
        "rate double, status string, level string"))
    with pytest.raises(ValueError, match="columns already"):
        model.cascade(df, {"Made": "1"})
