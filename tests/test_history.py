import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from strata.operators import history as H

D1, D2, D3 = dt.date(2026, 1, 1), dt.date(2026, 2, 1), dt.date(2026, 3, 1)
SRC = "k int, a string, b string"


def _snap(spark, data):
    return spark.createDataFrame(data, SRC)


def test_new_changed_unchanged_and_two_loads(spark):
    t = H.apply(None, _snap(spark, [(1, "x", "y"), (2, "p", "q")]), ["k"], ["a", "b"], D1)
    t2 = H.apply(t, _snap(spark, [(1, "x", "y2"), (2, "p", "q"), (3, "n", "n")]), ["k"], ["a", "b"], D2)
    t3 = H.apply(t2, _snap(spark, [(1, "x", "y3"), (2, "p", "q"), (3, "n", "n")]), ["k"], ["a", "b"], D3)
    got = rows(t3, "k", H.VERSION, H.CURRENT, H.START, H.END)
    assert got == [
        (1, 1, False, H.INITIAL_START, D2), (1, 2, False, D2, D3), (1, 3, True, D3, None),
        (2, 1, True, H.INITIAL_START, None), (3, 1, True, D2, None),
    ]
    # exactly one current version per key; intervals do not overlap
    assert t3.filter(F.col(H.CURRENT)).groupBy("k").count().filter("count <> 1").count() == 0
    assert H.overlaps(t3, ["k"]).count() == 0


def test_null_moved_between_columns_is_a_change(spark):
    t = H.apply(None, _snap(spark, [(1, None, "a")]), ["k"], ["a", "b"], D1)
    new, changed = H.detect(t, _snap(spark, [(1, "a", None)]), ["k"], ["a", "b"])
    assert new.count() == 0 and changed.count() == 1


def test_separator_inside_values_is_a_change(spark):
    t = H.apply(None, _snap(spark, [(1, "a|", "|b")]), ["k"], ["a", "b"], D1)
    _, changed = H.detect(t, _snap(spark, [(1, "a||", "b")]), ["k"], ["a", "b"])
    assert changed.count() == 1


def test_duplicate_keys_in_source_reduced_first(spark):
    src = spark.createDataFrame([(1, "old", "z", 1), (1, "new", "z", 2)], "k int, a string, b string, seq int")
    t = H.apply(None, src, ["k"], ["a", "b"], D1, attrs=["a", "b"], source_order=["seq"])
    assert rows(t, "k", "a") == [(1, "new")]


def test_missing_hash_recomputed(spark):
    t = H.apply(None, _snap(spark, [(1, "x", "y")]), ["k"], ["a", "b"], D1).withColumn(H.HASH, F.lit(None).cast("string"))
    t2 = H.apply(t, _snap(spark, [(1, "x", "y")]), ["k"], ["a", "b"], D2)
    assert t2.count() == 1      # unchanged key is not versioned again


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 4), st.sampled_from(["x", "y", None])), max_size=6),
                min_size=1, max_size=4))
def test_scd2_invariants_over_loads(spark, loads):
    t = None
    for i, load in enumerate(loads):
        snap = _snap(spark, [(k, v, "b") for k, v in dict(load).items()]) if load else \
            spark.createDataFrame([], SRC)
        t = H.apply(t, snap, ["k"], ["a", "b"], dt.date(2026, 1, 1) + dt.timedelta(days=i))
    cur = t.filter(F.col(H.CURRENT)).groupBy("k").count()
    assert cur.filter("count <> 1").count() == 0                  # one current version per key
    assert H.overlaps(t, ["k"]).count() == 0                      # disjoint intervals
    assert t.filter(F.col(H.END).isNotNull() & (F.col(H.END) < F.col(H.START))).count() == 0


def test_overlaps_finds_bad_neighbours(spark):
    v = spark.createDataFrame([
        (1, 1, dt.date(2020, 1, 1), dt.date(2021, 1, 1)), (1, 2, dt.date(2021, 1, 1), None),      # fine
        (2, 1, dt.date(2020, 1, 1), dt.date(2021, 6, 1)), (2, 2, dt.date(2021, 1, 1), None),      # overlap
        (3, 1, dt.date(2020, 1, 1), None), (3, 2, dt.date(2021, 1, 1), None),                     # never closed
    ], f"k int, {H.VERSION} int, {H.START} date, {H.END} date")
    assert rows(H.overlaps(v, ["k"]), "k", H.VERSION) == [(2, 1), (3, 1)]


def test_overlaps_with_repeated_and_missing_numbers(spark):
    d = dt.date
    v = spark.createDataFrame([
        (1, 1, d(2020, 1, 1), d(2021, 1, 1)), (1, 1, d(2020, 6, 1), d(2021, 1, 1)), (1, 3, d(2021, 1, 1), None),
        (2, 1, d(2020, 1, 1), d(2022, 1, 1)), (2, 7, d(2021, 1, 1), None),
        (None, 1, d(2020, 1, 1), None), (None, 2, d(2021, 1, 1), None),
    ], f"k int, {H.VERSION} int, {H.START} date, {H.END} date")
    assert rows(H.overlaps(v, ["k"]), "k", H.START) == [(1, d(2020, 1, 1)), (2, d(2020, 1, 1)), (None, d(2020, 1, 1))]


def test_late_snapshot_closes_nothing_and_null_key_is_one_key(spark):
    t = H.apply(None, _snap(spark, [(1, "x", "y"), (None, "p", "q")]), ["k"], ["a", "b"], D2, initial_start=D2)
    changed = _snap(spark, [(1, "x", "z"), (None, "p", "q")])
    back = H.apply(t, changed, ["k"], ["a", "b"], D1)
    assert rows(back, "k", H.CURRENT, H.END) == [(1, True, None), (None, True, None)]
    assert rows(H.late(t, changed, ["k"], ["a", "b"], D1), "k") == [(1,)]
    now = H.apply(t, changed, ["k"], ["a", "b"], D3)
    assert now.filter("k is null").count() == 1 and now.filter("k = 1").count() == 2
