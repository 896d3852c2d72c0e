"""Late rows of a stream: nothing that comes after the watermark is lost.

Each micro-batch is split by the watermark in force (the newest event time of the batches before it,
less the delay): on-time rows are deduplicated by Spark's own state, which a key leaves when the
watermark passes it; late rows, and rows without an event time, go to a sink of their own. So the rows kept, the
late rows and the duplicates add up to the rows that landed.

Under `path`: `landed/late=<flag>/batch=<id>` the rows as they were split, `marks/batch=<id>` one row per
batch that commits the split, `kept` the deduplicated rows. A replayed batch with a mark is not
split again; one without is overwritten, as the deduplication starts only after the mark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ingest

MARK_SCHEMA = "newest timestamp, on_time bigint, late bigint, batch bigint"


def marks(spark: SparkSession, path: str) -> DataFrame:
    """One row per split batch: newest event time so far, rows on time and late."""
    try:
        return spark.read.schema(MARK_SCHEMA).parquet(f"{path}/marks")
    except AnalysisException:
        return spark.createDataFrame([], MARK_SCHEMA)


def late_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The late rows, with the `batch` they came in."""
    split = T.StructType([*schema.fields, T.StructField("late", T.BooleanType()), T.StructField("batch", T.LongType())])
    return spark.read.schema(split).parquet(f"{path}/landed").where("late").drop("late")


def held_keys(spark: SparkSession, checkpoint: str, keys: Sequence[str]) -> DataFrame:
    """The keys that the deduplication of `drain_with_late` still holds."""
    state = spark.read.format("statestore").load(f"{checkpoint}/kept")
    return state.select(*[F.col("key")[k].alias(k) for k in keys])


def _split(batch: DataFrame, batch_id: int, event_time: str, delay: str, path: str) -> None:
    spark = batch.sparkSession
    newest = marks(spark, path).where(F.col("batch") < batch_id).agg(F.max("newest")).first()[0]
    at = F.col(event_time).cast("timestamp")
    late = at.isNull()
    if newest is not None:      # the watermark has milliseconds
        late = late | (at <= F.date_trunc("millisecond", F.lit(newest)) - F.expr(f"interval {delay}"))
    seen = Observation(f"late-{batch_id}")
    rows = batch.withColumns({"late": late, "batch": F.lit(batch_id).cast("bigint")}).observe(
        seen, F.max(at).alias("newest"), F.count_if(~late).alias("on_time"), F.count_if(late).alias("late"))
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("late", "batch")
     .parquet(f"{path}/landed"))
    found = seen.get
    newest = max((x for x in (newest, found["newest"]) if x is not None), default=None)
    (spark.createDataFrame([(newest, found["on_time"], found["late"])], "newest timestamp, on_time bigint, late bigint")
     .write.mode("overwrite").parquet(f"{path}/marks/batch={batch_id}"))


def drain_with_late(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str,
                    path: str, checkpoint: str) -> dict:
    """Drain the backlog; `path/kept` gets one row of each key that comes on time. Returns the last
    progress. `stream` may hold no columns named late or batch."""
    schema = stream.schema

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if marks(spark, path).where(F.col("batch") == batch_id).isEmpty():
            _split(batch, batch_id, event_time, delay, path)
        if marks(spark, path).where((F.col("batch") == batch_id) & (F.col("on_time") > 0)).isEmpty():
            return
        # one micro-batch: the files of this batch are the only ones not seen yet
        on_time = (spark.readStream.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())]))
                   .parquet(f"{path}/landed/late=false").drop("batch"))
        done = ingest.drain(ingest.dedup_within_watermark(on_time, keys, event_time, delay),
                            f"{path}/kept", f"{checkpoint}/kept", ingest_ts=False)
        if done["late_rows"]:
            raise RuntimeError(f"{done['late_rows']} rows of batch {batch_id} were dropped after they were found on time")

    q = (stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", f"{checkpoint}/split")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    return q.lastProgress or {}
