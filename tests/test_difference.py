"""Events from two states: every kind of row, NULL values and keys, tombstones, and the round trip."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from pyspark.sql import functions as F
from strata.operators import changes as C
from strata.operators import difference as D

STATE = "k string, v int, w string"
FULL = "k string, v int, w string, ts timestamp, lsn long, is_deleted boolean"
T0 = dt.datetime(2024, 1, 1)


def test_every_kind_of_row(spark):
    before = spark.createDataFrame([("same", 1, None), ("new value", 1, "x"), ("gone", 2, "y"), ("to null", 3, "z"),
                                    (None, 4, "n")], STATE)
    after = spark.createDataFrame([("same", 1, None), ("new value", 5, "q"), ("fresh", None, None), ("to null", None, "z"),
                                   (None, 4, "m")], STATE)
    got = {r.k: (r.v, r.w, r.op, r.changed_columns) for r in D.snapshot_changes(before, after, ["k"]).collect()}
    assert got == {"new value": (5, "q", "UPDATE", ["v", "w"]), "gone": (2, "y", "DELETE", None),
                   "fresh": (None, None, "INSERT", None), "to null": (None, "z", "UPDATE", ["v"]),
                   None: (4, "m", "UPDATE", ["w"])}


def test_tombstones_are_absent(spark):
    schema = "k string, v int, is_deleted boolean"
    before = spark.createDataFrame([("revived", 1, True), ("buried", 2, False), ("stays", 3, True), ("unset", 4, None)], schema)
    after = spark.createDataFrame([("revived", 1, False), ("buried", 2, True), ("stays", 9, True), ("unset", 4, False)], schema)
    got = D.snapshot_changes(before, after, ["k"], deleted_col="is_deleted")
    assert rows(got, "k", "op") == [("buried", "DELETE"), ("revived", "INSERT")]


def test_empty_states_and_no_tracked_columns(spark):
    none, one = spark.createDataFrame([], STATE), spark.createDataFrame([("a", 1, "x")], STATE)
    assert D.snapshot_changes(none, none, ["k"]).isEmpty()
    assert rows(D.snapshot_changes(none, one, ["k"]), "op") == [("INSERT",)]
    assert rows(D.snapshot_changes(one, none, ["k"]), "op") == [("DELETE",)]
    assert D.snapshot_changes(one, one, ["k", "v", "w"]).isEmpty()


STATES = st.dictionaries(st.sampled_from(["a", "b", "c", None]),
                         st.tuples(st.sampled_from([None, 1, 2]), st.sampled_from([None, "x", "y"])))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(STATES, STATES)
def test_events_lead_from_one_state_to_the_other(spark, first, second):
    a = spark.createDataFrame([(k, *v, T0, 0, False) for k, v in first.items()], FULL)
    b = spark.createDataFrame([(k, *v) for k, v in second.items()], STATE)
    events = D.snapshot_changes(a, b, ["k"], ["v", "w"],
                                stamp={"ts": F.lit(dt.datetime(2025, 1, 1)), "lsn": F.lit(1).cast("long")})
    again = C.apply_changes(a, events, ["k"], value_cols=["v", "w"])
    assert rows(again.where("not is_deleted"), "k", "v", "w") == rows(b)
