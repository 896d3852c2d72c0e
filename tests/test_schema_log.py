"""The schema log: restarts, types of new fields, replays and refusals."""
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import types as T

from conftest import rows
from strata.streaming.schema_log import SchemaLog, drain_evolving, read_sink

DECLARED = T.StructType([T.StructField("id", T.LongType())])


def land(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def test_fields_are_added_and_others_rescued(spark, scratch):
    landing, location, sink, ckpt = scratch(), scratch(), scratch(), scratch()
    drain = lambda: drain_evolving(spark, landing, DECLARED, location, sink, ckpt, max_files_per_trigger=1)
    land(spark, landing, ['{"id": 1}', '{"id": "x"}', "no json"])
    assert drain() == {"version": 1, "restarts": 0}
    land(spark, landing, ['{"id": 2, "n": 5, "p": 1.5, "ok": true, "s": "a"}', '{"id": 3, "n": 7, "s": "3"}'])
    land(spark, landing, ['{"id": 4, "n": "many", "later": 1}'])
    assert drain() == {"version": 3, "restarts": 2}
    log = SchemaLog(spark, location).versions()
    assert [len(s.fields) for s in log.values()] == [1, 5, 6]
    kinds = {f.name: f.dataType.simpleString() for f in log[3].fields}
    assert kinds == {"id": "bigint", "n": "bigint", "p": "double", "ok": "boolean", "s": "string", "later": "bigint"}
    got = read_sink(spark, location, sink)
    assert rows(got, "id", "n", "s", "later") == sorted(
        [(1, None, None, None), (None, None, None, None), (None, None, None, None), (2, 5, "a", None), (3, 7, "3", None),
         (4, None, None, 1)], key=lambda t: tuple((x is None, str(x)) for x in t))
    assert got.where("_rescued_data['n'] = 'many'").count() == 1 and got.where("_corrupt_record = 'no json'").count() == 1
    assert drain() == {"version": 3, "restarts": 0} and read_sink(spark, location, sink).count() == 6


def test_names_that_differ_in_case_are_refused(spark, scratch):
    landing, location, sink = scratch(), scratch(), scratch()
    land(spark, landing, ['{"id": 1, "ID": 2}'])
    with pytest.raises(StreamingQueryException):
        drain_evolving(spark, landing, DECLARED, location, sink, scratch())
    assert len(SchemaLog(spark, location).versions()) == 1


def test_two_runs_cannot_add_the_same_version(spark, scratch):
    log = SchemaLog(spark, scratch())
    assert log.latest() is None and log.append(DECLARED) == 1 and log.latest() == (1, DECLARED)
    stale = SchemaLog(spark, log.location)
    stale.latest = lambda: (0, None)
    with pytest.raises(RuntimeError):
        stale.append(DECLARED)
