import datetime as dt

from conftest import rows
from strata.operators import changes as C

T = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
TGT = "k string, value double, ts timestamp_ntz, lsn long, is_deleted boolean"
CHG = "k string, value double, ts timestamp_ntz, lsn long, op string"


def test_branches(spark):
    target = spark.createDataFrame([
        ("keep", 1.0, T(0), 1, False), ("upd", 2.0, T(0), 2, False), ("del", 3.0, T(0), 3, False),
        ("late", 4.0, T(5), 4, False), ("gone", 5.0, T(0), 5, True), ("tie", 6.0, T(1), 10, False),
    ], TGT)
    chg = spark.createDataFrame([
        ("upd", 20.0, T(1), 12, "UPDATE"), ("del", None, T(1), 13, "DELETE"),
        ("late", 40.0, T(1), 14, "UPDATE"),            # older than stored: ignored
        ("gone", 50.0, T(2), 15, "INSERT"),           # re-insert after delete revives
        ("new", 60.0, T(2), 16, "INSERT"), ("ghost", None, T(2), 17, "DELETE"),
        ("tie", 66.0, T(1), 11, "UPDATE"),            # same ts, higher lsn wins
    ], CHG)
    out = C.apply_changes(target, chg, ["k"], value_cols=["value"], deleted_at_col="deleted_at",
                          outcome_col="outcome")
    got = {r.k: (r.value, r.is_deleted, r.outcome) for r in out.collect()}
    assert got == {
        "keep": (1.0, False, "untouched"), "upd": (20.0, False, "updated"),
        "del": (3.0, True, "deleted"), "late": (4.0, False, "ignored_late"),
        "gone": (50.0, False, "updated"), "new": (60.0, False, "inserted"),
        "tie": (66.0, False, "updated"),
    }
    assert out.filter("k = 'del'").first().deleted_at is not None


def test_empty_target_and_idempotence(spark):
    empty = spark.createDataFrame([], TGT)
    chg = spark.createDataFrame([("a", 1.0, T(1), 1, "INSERT"), ("b", None, T(1), 2, "DELETE")], CHG)
    once = C.apply_changes(empty, chg, ["k"], value_cols=["value"])
    assert rows(once, "k", "value") == [("a", 1.0)]
    twice = C.apply_changes(once, chg, ["k"], value_cols=["value"])
    assert rows(twice) == rows(once)


def test_latest_changes_and_unknown_deletes(spark):
    log = spark.createDataFrame([("a", 1.0, T(1), 1, "INSERT"), ("a", 2.0, T(1), 2, "UPDATE"),
                                 ("z", None, T(1), 3, "DELETE")], CHG)
    latest, sup = C.latest_changes(log, ["k"])
    assert rows(latest, "k", "lsn") == [("a", 2), ("z", 3)]
    assert rows(sup, "lsn") == [(1,)]
    tgt = spark.createDataFrame([("a", 0.0, T(0), 0, False)], TGT)
    assert rows(C.unknown_deletes(tgt, latest, ["k"]), "k") == [("z",)]


def test_updates_derived_from_inserts_then_applied_in_one_batch(spark):
    # change-log fixture shape: UPDATE events derived from a subset of INSERT events
    from pyspark.sql import functions as F
    ins = spark.createDataFrame([(f"m{i}", float(i), T(0), i, "INSERT") for i in range(10)], CHG)
    upd = (ins.filter(F.col("lsn") % 5 == 0)
           .withColumns({"value": F.col("value") + 500, "lsn": F.col("lsn") + 100, "op": F.lit("UPDATE")}))
    log = ins.unionByName(upd)                      # same timestamp: lsn orders them
    latest, sup = C.latest_changes(log, ["k"])
    empty = spark.createDataFrame([], TGT)
    snap = C.apply_changes(empty, latest, ["k"], value_cols=["value"])
    assert rows(snap.filter("value >= 500"), "k") == [("m0",), ("m5",)]
    assert sup.count() == 2 and snap.count() == 10


from hypothesis import Phase, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 5), st.sampled_from(["INSERT", "UPDATE", "DELETE"])),
                max_size=25))
def test_apply_twice_equals_once(spark, events):
    log = spark.createDataFrame([(k, float(i), T(h), i, op) for i, (k, h, op) in enumerate(events)], CHG)
    latest = C.latest_changes(log, ["k"], with_superseded=False)
    empty = spark.createDataFrame([], TGT)
    once = C.apply_changes(empty, latest, ["k"], value_cols=["value"])
    twice = C.apply_changes(once, latest, ["k"], value_cols=["value"])
    assert rows(once) == rows(twice)


def test_sequential_insert_then_delete_leaves_tombstone(spark):
    empty = spark.createDataFrame([], TGT)
    batch = spark.createDataFrame([("a", 1.0, T(1), 1, "INSERT"), ("a", None, T(2), 2, "DELETE"),
                                   ("b", None, T(1), 3, "DELETE")], CHG)
    out = C.apply_changes_sequential(empty, batch, ["k"], ["value"])
    assert rows(out, "k", "value", "is_deleted") == [("a", 1.0, True)]
    latest_only = C.apply_changes(empty, C.latest_changes(batch, ["k"], with_superseded=False), ["k"],
                                  value_cols=["value"])
    assert latest_only.count() == 0          # the reference-compatible default drops it


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 6), st.sampled_from(["INSERT", "UPDATE", "DELETE"])),
                max_size=14),
       st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 6), st.booleans()), max_size=3, unique_by=lambda x: x[0]))
def test_sequential_batch_equals_one_at_a_time(spark, events, start):
    target = spark.createDataFrame([(k, 100.0 + h, T(h), 1000 + i, d) for i, (k, h, d) in enumerate(start)], TGT)
    changes = [(k, float(i), T(h), i, op) for i, (k, h, op) in enumerate(events)]
    batch = spark.createDataFrame(changes, CHG)
    once = C.apply_changes_sequential(target, batch, ["k"], ["value"])
    # reference: one change at a time, in (ts, lsn) order, through the single-change path
    state = target
    for ch in sorted(changes, key=lambda c: (c[2], c[3])):
        state = C.apply_changes(state, spark.createDataFrame([ch], CHG), ["k"], value_cols=["value"])
        state = spark.createDataFrame(state.collect(), TGT)      # keep the loop's plans small
    assert rows(once, "k", "value", "ts", "lsn", "is_deleted") == rows(state, "k", "value", "ts", "lsn", "is_deleted")


@settings(max_examples=10, deadline=None, phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 9), st.sampled_from(["INSERT", "UPDATE", "DELETE"])),
                min_size=1, max_size=12),
       st.randoms(use_true_random=False))
def test_unknown_delete_tombstones_make_arrival_order_irrelevant(spark, events, rnd):
    changes = [(k, float(i), T(h), i, op) for i, (k, h, op) in enumerate(events)]
    empty = spark.createDataFrame([], TGT)
    whole = C.apply_changes_sequential(empty, spark.createDataFrame(changes, CHG), ["k"], ["value"],
                                       keep_unknown_deletes=True)
    shuffled = changes[:]
    rnd.shuffle(shuffled)
    state = empty
    for i in range(0, len(shuffled), 3):                 # batches arrive in a random order
        batch = spark.createDataFrame(shuffled[i:i + 3], CHG)
        state = C.apply_changes_sequential(state, batch, ["k"], ["value"], keep_unknown_deletes=True)
        state = spark.createDataFrame(state.collect(), state.schema)
    cols = ("k", "value", "ts", "lsn", "is_deleted")
    assert rows(state, *cols) == rows(whole, *cols)


def test_sequential_deleted_at_and_revival(spark):
    empty = spark.createDataFrame([], TGT)
    b1 = spark.createDataFrame([("a", 1.0, T(1), 1, "INSERT"), ("a", None, T(3), 2, "DELETE")], CHG)
    s1 = C.apply_changes_sequential(empty, b1, ["k"], ["value"], deleted_at_col="deleted_at")
    r = s1.first()
    assert (r.value, r.is_deleted, r.deleted_at) == (1.0, True, T(3))
    b2 = spark.createDataFrame([("a", 5.0, T(4), 3, "UPDATE")], CHG)
    r2 = C.apply_changes_sequential(s1, b2, ["k"], ["value"], deleted_at_col="deleted_at").first()
    assert (r2.value, r2.is_deleted, r2.deleted_at) == (5.0, False, None)
    assert r2[C.UPSERT_ORDER_PREFIX + "ts"] == T(4)
