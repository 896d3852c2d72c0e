import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from strata.operators import dedup

T0 = dt.datetime(2024, 1, 1)


def test_ties_copies_three_way_and_null_key(spark):
    df = spark.createDataFrame([
        ("a", T0, 1), ("a", T0, 2),                 # tie on ts, lsn decides
        ("b", T0, 5), ("b", T0, 6), ("b", T0, 7),   # three-way
        (None, T0, 8), (None, T0, 9),               # NULL key is one group
    ], "k string, ts timestamp_ntz, lsn long")
    win, lose = dedup.latest(df, ["k"], ["ts", "lsn"])
    assert rows(win, "k", "lsn") == [("a", 2), ("b", 7), (None, 9)]
    assert rows(lose, "lsn") == [(1,), (5,), (6,), (8,)]


def test_exact_copies_with_row_locator(spark, scratch):
    df = spark.createDataFrame([("a", T0)] * 5 + [("b", T0)], "k string, ts timestamp_ntz")
    p = scratch("copies")
    df.repartition(2).write.parquet(p)
    back = dedup.with_row_locator(spark.read.parquet(p))
    win, lose = dedup.latest(back, ["k"], ["ts", "_row_locator"])
    assert win.count() == 2 and lose.count() == 4


def _plan(df):
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    return qe.executedPlan().toString()


def test_hot_key_is_reduced_before_the_shuffle(spark):
    data = [("hot" if i % 3 == 0 else f"k{i}", T0 + dt.timedelta(seconds=i), i) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, lsn long")
    w = dedup.winners(df, ["k"], ["ts", "lsn"])
    plan = _plan(w)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert w.count() == 2001 and w.filter("k = 'hot'").first().lsn == 2997
    m = dedup.mark_latest(df, ["k"], ["ts", "lsn"])
    assert "__split" in _plan(m)                        # first ranked within each input split
    assert m.filter("_is_latest").count() == 2001


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3)), min_size=0, max_size=40))
def test_exactly_one_winner_per_key_also_on_ties(spark, pairs):
    data = [(k, T0 + dt.timedelta(hours=h)) for k, h in pairs]          # no unique column: copies occur
    df = spark.createDataFrame(data, "k int, ts timestamp_ntz").repartition(3)
    m = dedup.mark_latest(df, ["k"], ["ts"])
    best = {}
    for k, t in data:
        best[k] = max(best.get(k, t), t)
    assert rows(m.filter("_is_latest"), "k", "ts") == rows(dedup.winners(df, ["k"], ["ts"])) == sorted(best.items())
    assert m.count() == len(data)


def test_where_excludes_rows(spark):
    df = spark.createDataFrame([("a", T0, 1, True), ("a", T0, 2, False)],
                               "k string, ts timestamp_ntz, lsn long, ok boolean")
    m = dedup.mark_latest(df, ["k"], ["ts", "lsn"], where=F.col("ok"))
    assert rows(m, "lsn", "_is_latest") == [(1, True), (2, None)]
