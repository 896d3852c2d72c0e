"""Structured Streaming ingest: drain a landing folder exactly once, split quality per
micro-batch idempotently, and drop duplicates within a watermark.

A drain is `readStream` with a declared schema → lineage columns → `writeStream` in
append mode with a checkpoint and `trigger(availableNow=True)`, and it is *awaited*:
the call returns only when the backlog is committed, and re-raises a failed query.
Re-running with the same checkpoint reads only files it has not seen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import rules as R
from ..sources.readers import conform_rescued, parse_json_rescued


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
                max_files_per_trigger: int | None = None, rescue: bool = False, **options) -> DataFrame:
    """Streaming file source with a declared schema and `_source_file` lineage.

    rescue=True keeps unknown and ill-typed fields in `_rescued_data`: JSON lines are read as
    text (non-JSON lines go to `_corrupt_record`); Parquet files are read with the merged
    schema of the files there, and what the declared schema lacks or can't hold is rescued.
    """
    r = spark.readStream.options(**options)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if rescue and fmt == "parquet":
        found = spark.read.option("mergeSchema", "true").parquet(path).schema     # footers only
        df = r.format(fmt).schema(found).load(path)
        return conform_rescued(df.withColumn("_source_file", F.col("_metadata.file_path")), schema,
                               keep=("_source_file",))
    if rescue:
        text = r.format("text").load(path).withColumn("_source_file", F.col("_metadata.file_path"))
        return parse_json_rescued(text, schema, keep=("_source_file",))
    df = r.format(fmt).schema(schema).load(path)
    return df.withColumn("_source_file", F.col("_metadata.file_path"))


def drain(stream: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet",
          ingest_ts: bool = True, partition_by: Sequence[str] = ()) -> dict:
    """Append the whole backlog to `sink_path` and wait; returns the last progress, with the
    number of rows that came after the watermark as `late_rows` (they are not in the sink)."""
    if ingest_ts:
        stream = stream.withColumn("_ingestion_timestamp", F.current_timestamp())
    w = (stream.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start(sink_path)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    late = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for op in p["stateOperators"])
    return {**dict(q.lastProgress or {}), "late_rows": late}


def quality_split(stream: DataFrame, rules: Sequence[R.Rule], out_path: str, checkpoint: str,
                  fmt: str = "parquet") -> dict:
    """Tag every micro-batch and write valid / quarantined rows under
    `<out>/_disposition=<d>/batch=<id>`; a replayed batch overwrites its own folders,
    so a restart after a crash never duplicates rows."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        tagged = R.tag_rules(batch, rules)
        disp = F.when(F.col(R.PASSED), F.lit(R.VALID)).otherwise(F.lit(R.QUARANTINED))
        out = tagged.withColumns({R.DISPOSITION: disp, "batch": F.lit(batch_id)})
        (out.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(R.DISPOSITION, "batch").save(out_path))

    q = (stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    return q.lastProgress or {}


def dedup_within_watermark(stream: DataFrame, keys: Sequence[str], event_time: str,
                           delay: str = "1 hour") -> DataFrame:
    """Streaming dedup with bounded state: first-seen wins (unlike batch latest-wins) and a key is
    forgotten once the watermark passes it. Rows later than the watermark are dropped by
    Spark; `drain` reports how many.

    `timestamp_ntz` event times are cast to `timestamp` as watermarks require.
    """
    s = stream
    if dict(s.dtypes).get(event_time) == "timestamp_ntz":
        s = s.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return s.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def apply_changes_stream(stream: DataFrame, path: str, keys: Sequence[str],
                         schema: T.StructType, checkpoint: str, order: Sequence[str] = ("ts", "lsn"),
                         op: str = "op", value_cols: Sequence[str] | None = None,
                         sequential: bool = False, keep_unknown_deletes: bool = False) -> dict:
    """Continuous CDC: each micro-batch is merged into the current state and written as the next
    snapshot under `path`. A replayed batch starts from the state before it and replaces its
    own snapshot, so the sink is idempotent.

    sequential=True applies each batch as if its changes came one at a time (an insert
    and a delete of a new key in one batch leave a tombstone); with files arriving in
    time order the final table then does not depend on where batches are cut. Declaring
    the `_up_<order col>` columns in the table schema keeps the last-upsert register too,
    and with `keep_unknown_deletes` the result no longer depends on arrival order."""
    from ..operators import changes as C
    from ..operators import snapshots

    def merged(current: DataFrame, batch: DataFrame) -> DataFrame:
        if sequential:
            vals = value_cols or [c for c in batch.columns if c not in [*keys, *order, op]]
            return C.apply_changes_sequential(current, batch, keys, vals, order=order, op=op,
                                              keep_unknown_deletes=keep_unknown_deletes)
        latest = C.latest_changes(batch, keys, order, with_superseded=False)
        return C.apply_changes(current, latest, keys, value_cols=value_cols, order=order, op=op)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        snapshots.advance(batch.sparkSession, path, batch, merged, schema, version=batch_id)

    q = (stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    return q.lastProgress or {}
