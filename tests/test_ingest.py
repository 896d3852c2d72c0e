import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL, rows
from strata.operators import rules as R
from strata.sources import readers, writers
from strata.streaming import ingest

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("temp", T.DoubleType()),
                       T.StructField("dev", T.StringType())])


def _write_lines(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


def test_rescued_unknown_field_bad_type_and_corrupt_line(spark, scratch):
    p = scratch("rescue")
    _write_lines(spark, p, [json.dumps({"id": 1, "temp": 20.5, "dev": "a"}),
                            json.dumps({"id": 2, "temp": "hot", "dev": "b", "extra": 7}),
                            "{not json"])
    df = readers.read_json_rescued(spark, p, SCHEMA)
    got = {r.id: r for r in df.collect()}
    assert got[1][readers.RESCUED] is None and got[1].temp == 20.5
    assert got[2].temp is None and got[2][readers.RESCUED] == {"temp": "hot", "extra": "7"}
    corrupt = df.filter(F.col(readers.CORRUPT).isNotNull()).collect()
    assert len(corrupt) == 1 and corrupt[0][readers.CORRUPT] == "{not json"
    assert all(r._source_file for r in df.collect())


def test_conform_casts_fills_and_drops(spark):
    df = spark.createDataFrame([("1", 2.345, "x")], "a string, b double, junk string")
    target = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DecimalType(12, 2)),
                           T.StructField("c", T.DateType())])
    out = writers.conform(df, target)
    assert out.schema == target
    r = out.first()
    assert r.a == 1 and str(r.b) == "2.35" and r.c is None


def test_run_keyed_write_is_idempotent(spark, scratch):
    p = scratch("runs")
    df = spark.range(10)
    writers.write_run(df, p, "run-a")
    writers.write_run(df, p, "run-a")     # retry of the same run replaces
    writers.write_run(df, p, "run-b")
    back = spark.read.parquet(p)
    assert back.count() == 20
    assert rows(back.groupBy(writers.RUN_COL).count()) == [("run-a", 10), ("run-b", 10)]


def test_lineage_literal_and_extended(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ts = F.lit(dt.datetime(2026, 1, 1)).cast("timestamp")
    a = readers.with_lineage(ev, ingest_ts=ts, extended=True).first()
    assert a._source_file_name == "events.parquet" and a._source_file_size > 0
    b = readers.with_lineage(ev, source_name="catalog.tbl").first()
    assert b._source_file == "catalog.tbl"


def test_schema_drift(spark):
    df = spark.createDataFrame([(1, "x")], "id int, extra string")
    d = readers.schema_drift(df, SCHEMA)
    assert d["added"] == ["extra"] and d["missing"] == ["dev", "temp"] and d["retyped"] == ["id"]


def _landing(spark, scratch, n_files=3):
    p = scratch("landing")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ev.repartition(n_files).write.json(p)
    return p, ev.count()


EV_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                          T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
                          T.StructField("value", T.DoubleType())])


def test_drain_twice_adds_nothing_and_new_file_is_picked_up(spark, scratch):
    land, n = _landing(spark, scratch)
    sink, ck = scratch("sink"), scratch("ck")
    ingest.drain(ingest.file_stream(spark, land, EV_SCHEMA, max_files_per_trigger=1), sink, ck)
    ingest.drain(ingest.file_stream(spark, land, EV_SCHEMA, max_files_per_trigger=1), sink, ck)
    assert spark.read.parquet(sink).count() == n
    extra = spark.createDataFrame([(999999, dt.datetime(2024, 2, 1), 1, "click", 1.0)], EV_SCHEMA)
    extra.write.mode("append").json(land)
    ingest.drain(ingest.file_stream(spark, land, EV_SCHEMA), sink, ck)
    assert spark.read.parquet(sink).count() == n + 1


def test_stream_rescue_mode(spark, scratch):
    p = scratch("srescue")
    _write_lines(spark, p, [json.dumps({"id": 1, "temp": 1.0, "dev": "a", "new": "x"}), "garbage"])
    sink, ck = scratch("sink"), scratch("ck")
    ingest.drain(ingest.file_stream(spark, p, SCHEMA, rescue=True), sink, ck)
    out = spark.read.parquet(sink)
    assert out.filter(F.col(readers.CORRUPT).isNotNull()).count() == 1
    assert out.filter(F.col(readers.RESCUED).isNotNull()).count() == 1


def test_streaming_quality_split_is_replay_safe(spark, scratch):
    land, n = _landing(spark, scratch, 4)
    rules = [R.in_range("value", 0, 150, "DQ-004")]
    out, ck = scratch("split"), scratch("ck")
    src = ingest.file_stream(spark, land, EV_SCHEMA, max_files_per_trigger=1)
    ingest.quality_split(src, rules, out, ck)
    ingest.quality_split(ingest.file_stream(spark, land, EV_SCHEMA, max_files_per_trigger=1), rules, out, ck)
    back = spark.read.parquet(out)
    assert back.count() == n
    bad = spark.read.parquet(f"{SF_SMALL}/events.parquet").filter("not (value between 0 and 150)").count()
    assert back.filter(F.col(R.DISPOSITION) == R.QUARANTINED).count() == bad


def test_dedup_within_watermark(spark, scratch):
    land = scratch("dups")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ev.unionByName(ev).repartition(2).write.json(land)
    src = ingest.file_stream(spark, land, EV_SCHEMA)
    d = ingest.dedup_within_watermark(src.drop("_source_file"), ["event_id"], "ts", "365 days")
    sink, ck = scratch("sink"), scratch("ck")
    ingest.drain(d, sink, ck, ingest_ts=False)
    assert spark.read.parquet(sink).count() == ev.count()


def test_promote_rescued_fields(spark, scratch):
    p = scratch("promote")
    _write_lines(spark, p, [json.dumps({"id": 1, "temp": 1.0, "dev": "a", "rpm": "1200", "x": 1}),
                            json.dumps({"id": 2, "temp": 2.0, "dev": "b", "rpm": "fast"})])
    df = readers.promote_rescued(readers.read_json_rescued(spark, p, SCHEMA), {"rpm": "int"})
    got = {r.id: (r.rpm, r[readers.RESCUED]) for r in df.collect()}
    assert got[1] == (1200, {"x": "1"})
    assert got[2] == (None, {"rpm": "fast"})


def test_streaming_cdc_merge_is_replay_safe(spark, scratch):
    from strata.operators import snapshots
    chg_schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("value", T.DoubleType()),
                               T.StructField("ts", T.TimestampNTZType()), T.StructField("lsn", T.LongType()),
                               T.StructField("op", T.StringType())])
    t0 = dt.datetime(2024, 1, 1)
    rows1 = [("a", 1.0, t0, 1, "INSERT"), ("b", 2.0, t0, 2, "INSERT"), ("a", 3.0, t0, 3, "UPDATE")]
    rows2 = [("b", None, t0 + dt.timedelta(1), 4, "DELETE"), ("c", 5.0, t0, 5, "INSERT")]
    land = scratch("cdc-landing")
    spark.createDataFrame(rows1, chg_schema).coalesce(1).write.json(land)
    spark.createDataFrame(rows2, chg_schema).coalesce(1).write.mode("append").json(land)
    table = scratch("cdc-table")
    empty = spark.createDataFrame([], "k string, value double, ts timestamp_ntz, lsn long, is_deleted boolean")
    schema = empty.schema
    ck = scratch("ck")
    for _ in range(2):     # second run: nothing new
        src = ingest.file_stream(spark, land, chg_schema, max_files_per_trigger=1).drop("_source_file")
        ingest.apply_changes_stream(src, table, ["k"], schema, ck, value_cols=["value"])
    out = snapshots.read(spark, table, schema)
    assert rows(out, "k", "value", "is_deleted") == [("a", 3.0, False), ("b", 2.0, True), ("c", 5.0, False)]


def test_dedup_counts_rows_after_the_watermark(spark, scratch):
    land = scratch("late")
    t0 = dt.datetime(2024, 1, 1)
    rows_ = lambda h, ids: spark.createDataFrame([(i, t0 + dt.timedelta(hours=h)) for i in ids], "event_id long, ts timestamp")
    schema = rows_(0, [1]).schema
    rows_(10, [1, 2, 2]).coalesce(1).write.json(land)
    sink, ck = scratch("sink"), scratch("ck")

    def drained():
        src = ingest.file_stream(spark, land, schema).drop("_source_file")
        return ingest.drain(ingest.dedup_within_watermark(src, ["event_id"], "ts", "1 hour"), sink, ck, ingest_ts=False)

    assert drained()["late_rows"] == 0
    rows_(2, [3]).coalesce(1).write.mode("append").json(land)         # eight hours late
    assert drained()["late_rows"] == 1
    assert rows(spark.read.parquet(sink), "event_id") == [(1,), (2,)]


def test_parquet_stream_rescues_what_does_not_fit(spark, scratch):
    land = scratch("pq")
    spark.createDataFrame([(1, "7", "x"), (2, "seven", None)], "id long, n string, extra string").write.parquet(land)
    src = ingest.file_stream(spark, land, T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.IntegerType())]),
                             "parquet", rescue=True)
    sink, ck = scratch("sink"), scratch("ck")
    ingest.drain(src.drop("_source_file"), sink, ck, ingest_ts=False)
    got = {r.id: (r.n, r[readers.RESCUED]) for r in spark.read.parquet(sink).collect()}
    assert got == {1: (7, {"extra": "x"}), 2: (None, {"n": "seven"})}


def test_sequential_stream_independent_of_batch_cuts(spark, scratch):
    from strata.operators import changes as C
    from strata.operators import snapshots
    from strata.plans.fixtures import change_log
    log = change_log(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    chg_schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("lsn", T.LongType()),
                               T.StructField("ts", T.TimestampNTZType()), T.StructField("value", T.DoubleType()),
                               T.StructField("op", T.StringType())])
    land = scratch("ordered-landing")
    cuts = ["2024-01-01", "2024-01-08", "2024-01-16", "2024-01-24", "2024-02-01"]
    for lo, hi in zip(cuts, cuts[1:]):          # files arrive in time order
        part = log.filter((F.col("ts") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("ts") < F.lit(hi).cast("timestamp_ntz")))
        part.coalesce(1).write.mode("append").json(land)
    empty = spark.createDataFrame([], "k bigint, value double, ts timestamp_ntz, lsn bigint, is_deleted boolean")
    table = scratch("seq-table")
    schema = empty.schema
    src = ingest.file_stream(spark, land, chg_schema, max_files_per_trigger=1).drop("_source_file")
    ingest.apply_changes_stream(src, table, ["k"], schema, scratch("ck"), value_cols=["value"], sequential=True)
    streamed = snapshots.read(spark, table, schema)
    whole = C.apply_changes_sequential(empty, log, ["k"], ["value"])
    cols = ("k", "value", "lsn", "is_deleted")
    assert rows(streamed, *cols) == rows(whole, *cols)
    assert whole.filter("is_deleted").count() > 0


def test_snapshot_versions_and_retry(spark, scratch):
    base = scratch("snap")
    p1 = writers.write_snapshot(spark.range(3), base, 1)
    p1b = writers.write_snapshot(spark.range(3), base, 1)     # retried job: same version replaced
    p2 = writers.write_snapshot(spark.read.parquet(p1).union(spark.range(3, 5)), base, 2)
    assert p1 == p1b and spark.read.parquet(p1).count() == 3 and spark.read.parquet(p2).count() == 5
