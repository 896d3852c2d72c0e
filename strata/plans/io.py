"""Ingest, stream and layout proofs. Each really writes, re-reads, drains or re-clusters
under a fresh folder inside the shared checkpoint folder before returning."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import layout, snapshots
from ..session import scratch_path
from ..sources import inference, readers, writers
from ..streaming import ingest, late, observe, schema_log
from .tables import Tables

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])
SUPPLIER_SCHEMA = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
EQUIPMENT_SCHEMA = T.StructType([
    T.StructField("equipment_id", T.StringType()), T.StructField("model_number", T.StringType()),
    T.StructField("asset_value", T.DecimalType(12, 2)), T.StructField("effective_end_date", T.DateType()),
])


def _spread(df, *cols):
    """As many landing files as the session has shuffle partitions."""
    return df.repartition(_files(df.sparkSession), *cols)


def _files(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def json_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "json")
    writers.write_landing(Tables(spark, sf_dir).events, path, "json")
    back = readers.read_json_rescued(spark, path, EVENTS_SCHEMA)
    return back.select("event_id", "user_id", "event_type", "value", F.to_date("ts").alias("d"))


def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    writers.write_landing(Tables(spark, sf_dir).supplier, path, "csv", header="true")
    return readers.read_csv(spark, path, SUPPLIER_SCHEMA).select(
        "s_suppkey", "s_name", "s_nationkey", "s_acctbal")


def source_file(spark, sf_dir):
    ev = readers.with_lineage(Tables(spark, sf_dir).events, extended=True)
    return ev.select("event_id", F.col("_source_file_name").alias("source_file"))


def source_file_details(spark, sf_dir):
    """File size and modification time of every row's source file."""
    ev = readers.with_lineage(Tables(spark, sf_dir).events, extended=True)
    return ev.select("event_id", (F.col("_source_file_size") > 0).alias("has_size"),
                     F.col("_source_file_mtime").isNotNull().alias("has_mtime"),
                     F.endswith(F.col("_source_file"), F.col("_source_file_name")).alias("in_path"))


def conform_schema(spark, sf_dir):
    s = Tables(spark, sf_dir).supplier.select(
        F.col("s_suppkey").alias("equipment_id"), F.col("s_name").alias("model_number"),
        F.col("s_acctbal").alias("asset_value"))
    return writers.conform(s, EQUIPMENT_SCHEMA)


def _landing(spark, sf_dir):
    landing = scratch_path(spark, "landing")
    ev = Tables(spark, sf_dir).events
    writers.write_landing(_spread(ev), landing, "json")
    return landing


def _drain(spark, landing, sink, ckpt):
    src = ingest.file_stream(spark, landing, EVENTS_SCHEMA, "json", max_files_per_trigger=max(1, _files(spark) // 2))
    return ingest.drain(src, sink, ckpt)


def stream_ingest(spark, sf_dir):
    landing = _landing(spark, sf_dir)
    sink, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "ckpt")
    _drain(spark, landing, sink, ckpt)
    return spark.read.parquet(sink).select("event_id", "user_id", "event_type", "value")


def stream_rerun(spark, sf_dir):
    landing = _landing(spark, sf_dir)
    sink, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "ckpt")
    _drain(spark, landing, sink, ckpt)
    _drain(spark, landing, sink, ckpt)   # nothing new: must add no rows
    return spark.read.parquet(sink).agg(F.count(F.lit(1)).alias("n"))


CLUSTER_COLS = ("l_shipdate", "l_partkey")


def layout_same_rows(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    path = scratch_path(spark, "clustered")
    layout.cluster(li, CLUSTER_COLS, n_files=_files(spark)).write.parquet(path)
    return spark.read.parquet(path)


def layout_compact(spark, sf_dir):
    """Many small files rewritten as few of the target size; the rows stay."""
    src, dst = scratch_path(spark, "small-files"), scratch_path(spark, "compacted")
    _spread(Tables(spark, sf_dir).lineitem).write.parquet(src)
    layout.compact_path(spark, src, dst)
    return spark.read.parquet(dst)


def run_retry(spark, sf_dir):
    """A run retried with other partitions: nothing of the first attempt stays."""
    path = scratch_path(spark, "retried")
    ev = Tables(spark, sf_dir).events
    writers.write_run(ev, path, "run-1", partition_by=["event_type"])
    second = ev.withColumn("event_type", F.when(F.col("event_type") == "error", F.lit("view")).otherwise(F.col("event_type")))
    writers.write_run(second, path, "run-1", partition_by=["event_type"])
    back = spark.read.parquet(path)
    return back.groupBy(F.col(writers.RUN_COL).alias("run_id"), "event_type").agg(F.count(F.lit(1)).alias("n"))


def partitioned_write(spark, sf_dir):
    """Orders written by priority and read back through the partition column."""
    path = scratch_path(spark, "by-priority")
    writers.write_partitioned(Tables(spark, sf_dir).orders, path, ["o_orderpriority"], mode="errorifexists")
    return spark.read.parquet(path).select("o_orderkey", "o_orderpriority", "o_totalprice")


def snapshot_versions(spark, sf_dir):
    """Two versions of a table, each readable under its own number."""
    base = scratch_path(spark, "versions")
    s = Tables(spark, sf_dir).supplier
    first = writers.write_snapshot(s, base, 1)
    second = writers.write_snapshot(s.withColumn("s_acctbal", F.col("s_acctbal") + 1), base, 2)
    a, b = spark.read.parquet(first), spark.read.parquet(second)
    return a.select("s_suppkey", F.col("s_acctbal").alias("before")).join(
        b.select("s_suppkey", F.col("s_acctbal").alias("after")), "s_suppkey")


def consolidate_tables(spark, sf_dir):
    """Violation tables of the catalog united; one that does not exist is skipped."""
    from ..operators import report
    t = Tables(spark, sf_dir)
    t.events.filter("value > 300").selectExpr("event_id as id", "event_type as reason").createOrReplaceTempView("strata_v1")
    t.orders.filter("o_totalprice < 2000").selectExpr("o_orderkey as id", "'price' as field_name").createOrReplaceTempView("strata_v2")
    return report.consolidate(spark, ["strata_v1", "strata_absent", "strata_v2"])


# The streaming quality rule of the proofs (same bounds as the batch one).
STREAM_VALUE_MIN, STREAM_VALUE_MAX = 0, 150
WATERMARK_DELAY = "1 hour"


def stream_dq_split(spark, sf_dir):
    """Micro-batch quality split through foreachBatch; the drain is replayed once."""
    from ..operators import rules as R
    landing = _landing(spark, sf_dir)
    out, ckpt = scratch_path(spark, "split"), scratch_path(spark, "ckpt")
    rule = [R.in_range("value", STREAM_VALUE_MIN, STREAM_VALUE_MAX, "DQ-004")]
    for _ in range(2):
        src = ingest.file_stream(spark, landing, EVENTS_SCHEMA, "json", max_files_per_trigger=max(1, _files(spark) // 2))
        ingest.quality_split(src, rule, out, ckpt)
    return spark.read.parquet(out).select("event_id", R.DISPOSITION)


def stream_dedup(spark, sf_dir):
    """Every event landed twice (in different files); watermark dedup keeps one of each."""
    landing = scratch_path(spark, "dup-landing")
    ev = Tables(spark, sf_dir).events
    writers.write_landing(_spread(ev.unionByName(ev)), landing, "json")
    src = ingest.file_stream(spark, landing, EVENTS_SCHEMA, "json").drop("_source_file")
    d = ingest.dedup_within_watermark(src, ["event_id"], "ts", WATERMARK_DELAY)
    sink, ckpt = scratch_path(spark, "dedup"), scratch_path(spark, "ckpt")
    progress = ingest.drain(d, sink, ckpt, ingest_ts=False)     # the backlog is one micro-batch
    if progress["late_rows"]:
        raise ValueError(f"{progress['late_rows']} rows came after the watermark")
    return spark.read.parquet(sink).select("event_id", "user_id")


# Fixed values of the late rows' proof: where its loads begin, the delay, and which events come a load
# late, twice in a load, or again in the next load.
LOADS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")
LATE_DELAY, HELD_BACK_EVERY, TWICE_EVERY, AGAIN_EVERY = "2 days", 13, 7, 5


def stream_late_rows(spark, sf_dir):
    """Four loads, one drain each, under a moving watermark. Of every event how often it was kept,
    late or a duplicate, and whether the state still holds it at the end."""
    landing, out, ckpt = (scratch_path(spark, x) for x in ("late-landing", "late-out", "ckpt"))
    ev = Tables(spark, sf_dir).events.select("event_id", "ts", "user_id")
    own = sum([F.when(F.col("ts") >= F.lit(b).cast("timestamp_ntz"), 1).otherwise(0) for b in LOADS], F.lit(0))
    first = F.col("own") + F.when(F.col("event_id") % HELD_BACK_EVERY == 0, 1).otherwise(0)
    arrivals = F.concat(F.array(first), *[F.when(F.col("event_id") % every == 0, F.array(load)).otherwise(F.array().cast("array<int>"))
                                          for every, load in ((TWICE_EVERY, first), (AGAIN_EVERY, F.col("own") + 1))])
    landed = ev.withColumn("own", own).withColumn("load", F.explode(arrivals)).drop("own")
    for load in range(len(LOADS) + 2):
        _spread(landed.where(F.col("load") == load).drop("load")).write.mode("append").parquet(landing)
        src = spark.readStream.schema(ev.schema).parquet(landing)
        late.drain_with_late(src, ["event_id"], "ts", LATE_DELAY, out, ckpt)
    split = spark.read.parquet(f"{out}/landed").select("event_id", "late")
    kept = spark.read.parquet(f"{out}/kept").select("event_id", F.lit(1).alias("kept"), F.lit(False).alias("held"))
    held = late.held_keys(spark, ckpt, ["event_id"]).select("event_id", F.lit(0).alias("kept"), F.lit(True).alias("held"))
    counted = split.select("event_id", F.lit(0).alias("kept"), F.lit(False).alias("held"), "late").unionByName(
        kept.unionByName(held).withColumn("late", F.lit(None).cast("boolean")))
    return counted.groupBy("event_id").agg(
        F.sum("kept").alias("kept"), F.count_if("late").alias("late"),
        (F.count_if(~F.col("late")) - F.sum("kept")).alias("duplicates"), F.bool_or("held").alias("held"))


def stream_ledger(spark, sf_dir):
    """Ledger of a drain of several micro-batches: rows in and rows within the rule, from every batch."""
    from ..context import RunContext
    from ..operators.report import Ledger
    ledger = Ledger(RunContext(run_id="run-1"))
    src = ingest.file_stream(spark, _landing(spark, sf_dir), EVENTS_SCHEMA, "json", max_files_per_trigger=max(1, _files(spark) // 4))
    observe.drain_observed(src, F.col("value").between(STREAM_VALUE_MIN, STREAM_VALUE_MAX), scratch_path(spark, "observed"),
                           scratch_path(spark, "ckpt"), ledger, "bronze")
    return ledger.to_df(spark).groupBy("pipeline_run_id", "status").agg(
        F.sum("rows_in").alias("rows_in"), F.sum("rows_out").alias("rows_out"), (F.count("*") > 1).alias("several"))


# Fixed values of the schema log's proof: where the second drain's files begin, and how often their
# user is no number.
SECOND_DRAIN, ODD_USER_EVERY = "2024-01-16 00:00:00", 11


def stream_schema_log(spark, sf_dir):
    """Two drains of one landing folder; the files of the second bring two new fields and users
    that are no numbers. `version` is that of the schema a row was written with."""
    landing, sink = scratch_path(spark, "evolving"), scratch_path(spark, "evolved")
    location, ckpt = scratch_path(spark, "schema-log"), scratch_path(spark, "ckpt")
    declared = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType())])
    ev = Tables(spark, sf_dir).events
    early = F.col("ts") < F.lit(SECOND_DRAIN).cast("timestamp_ntz")
    odd = F.col("event_id") % ODD_USER_EVERY == 0
    wide = ev.where(~early).select("event_id", "user_id", "value", "event_type")
    drains = [[ev.where(early).select("event_id", "user_id")],
              [wide.where(~odd), wide.where(odd).withColumn("user_id", F.concat(F.lit("u"), F.col("user_id").cast("string")))]]
    for loads in drains:
        for rows in loads:
            _spread(rows).write.mode("append").json(landing)
        schema_log.drain_evolving(spark, landing, declared, location, sink, ckpt, max(1, _files(spark) // 2))
    return schema_log.read_sink(spark, location, sink).select(
        "event_id", "user_id", "value", "event_type", F.col(readers.RESCUED)["user_id"].alias("user_id_text"),
        F.col(schema_log.VERSION).alias("version"))


# Fixed value: a declared schema that the landed events do not quite have.
LOOSELY_DECLARED = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", T.IntegerType()),
    T.StructField("value", T.LongType()), T.StructField("loaded_at", T.TimestampType())])


def schema_inferred(spark, sf_dir):
    """Schema inferred from half of the landed events, held against a declared one over all of them."""
    path = scratch_path(spark, "infer")
    writers.write_landing(Tables(spark, sf_dir).events, path, "json")
    return inference.drift_report(spark, path, LOOSELY_DECLARED, sampling_ratio=0.5)


KNOWN_EVENT_FIELDS = T.StructType([f for f in EVENTS_SCHEMA.fields if f.name != "props"])


def rescued_fields(spark, sf_dir):
    """Landed JSON read with a schema that lacks `props`: the field is rescued, not lost."""
    path = scratch_path(spark, "rescue")
    writers.write_landing(Tables(spark, sf_dir).events, path, "json")
    back = readers.read_json_rescued(spark, path, KNOWN_EVENT_FIELDS)
    return back.select("event_id", F.col(readers.RESCUED)["props"].alias("props"))


CHANGE_SCHEMA = T.StructType([
    T.StructField("k", T.LongType()), T.StructField("lsn", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()), T.StructField("value", T.DoubleType()),
    T.StructField("op", T.StringType()),
])


def stream_cdc_apply(spark, sf_dir):
    """The whole change log landed as JSON files (each key's changes in one file), drained
    micro-batch by micro-batch into an empty current state."""
    from .fixtures import change_log
    landing = scratch_path(spark, "cdc-landing")
    log = change_log(Tables(spark, sf_dir).events)
    writers.write_landing(_spread(log, "k"), landing, "json")
    table = scratch_path(spark, "cdc-table")
    schema = spark.createDataFrame([], "k bigint, value double, ts timestamp_ntz, lsn bigint, is_deleted boolean").schema
    src = ingest.file_stream(spark, landing, CHANGE_SCHEMA, "json", max_files_per_trigger=max(1, _files(spark) // 2))
    ingest.apply_changes_stream(src.drop("_source_file"), table, ["k"], schema,
                                scratch_path(spark, "ckpt"), value_cols=["value"])
    return snapshots.read(spark, table, schema).select("k", "value", "is_deleted")


def stream_parquet_rescue(spark, sf_dir):
    """Landed Parquet drained with a schema that lacks `props` and declares `event_type` a number:
    both are rescued, no row is lost."""
    landing = scratch_path(spark, "parquet-landing")
    _spread(Tables(spark, sf_dir).events).write.parquet(landing)
    declared = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType()),
                             T.StructField("event_type", T.IntegerType())])
    src = ingest.file_stream(spark, landing, declared, "parquet", rescue=True)
    sink, ckpt = scratch_path(spark, "rescued"), scratch_path(spark, "ckpt")
    ingest.drain(src.drop("_source_file"), sink, ckpt, ingest_ts=False)
    back = spark.read.parquet(sink)
    return back.select("event_id", "value", "event_type", F.col(readers.RESCUED)["event_type"].alias("event_type_text"),
                       F.col(readers.RESCUED)["props"].alias("props"))


def required_quarantine(spark, sf_dir):
    """Telemetry with NULL keys written to a table that may hold none: the rows with one go to
    quarantine with the names of their NULL columns."""
    from .fixtures import telemetry
    good, bad = scratch_path(spark, "required"), scratch_path(spark, "null-keys")
    writers.write_required(telemetry(Tables(spark, sf_dir).events), good, ["device_id", "facility_id"], bad)
    kept = spark.read.parquet(good).select("event_id", F.lit(None).cast("string").alias("null_columns"))
    return kept.unionByName(spark.read.parquet(bad).select("event_id", F.col("_null_columns").alias("null_columns")))


def schema_evolution(spark, sf_dir):
    """Landed JSON read with a schema that predates `value`; the rescued field is then
    promoted to a typed column (schema evolution without losing a row)."""
    path = scratch_path(spark, "evolve")
    writers.write_landing(Tables(spark, sf_dir).events, path, "json")
    old = T.StructType([f for f in EVENTS_SCHEMA.fields if f.name not in ("value", "props")])
    back = readers.promote_rescued(readers.read_json_rescued(spark, path, old), {"value": "double"})
    return back.select("event_id", "value")


def stream_cdc_out_of_order(spark, sf_dir):
    """The whole change log landed batch by batch, one event type each, written (so arriving) in a
    non-chronological order — deletes first — and drained micro-batch by micro-batch into
    a current state that keeps both registers (`_up_*` columns)."""
    from .cdc import ARRIVAL_ORDER
    from .fixtures import change_log
    log = change_log(Tables(spark, sf_dir).events.withColumn("batch", F.col("event_type")), carry=("batch",))
    landing = scratch_path(spark, "ooo-landing")
    for b in ARRIVAL_ORDER:            # one append per batch: file times follow this order
        log.filter(F.col("batch") == b).drop("batch").write.mode("append").json(landing)
    table = scratch_path(spark, "ooo-table")
    schema = spark.createDataFrame([], "k bigint, value double, ts timestamp_ntz, lsn bigint, "
                                       "is_deleted boolean, _up_ts timestamp_ntz, _up_lsn bigint").schema
    src = ingest.file_stream(spark, landing, CHANGE_SCHEMA, "json", max_files_per_trigger=max(1, _files(spark) // 2))
    ingest.apply_changes_stream(src.drop("_source_file"), table, ["k"], schema,
                                scratch_path(spark, "ckpt"), value_cols=["value"], sequential=True,
                                keep_unknown_deletes=True)
    return snapshots.read(spark, table, schema).select("k", "value", "is_deleted")
