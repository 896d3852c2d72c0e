"""Schema location of an incremental read: a kept, versioned log of the stream's schema.

The first drain starts from the declared schema. Files that bring fields the log doesn't have stop
the stream before their micro-batch is written; the fields are added to the log as a new version
and the stream starts again from its checkpoint with the wider schema, so the stopped batch is
read anew and nothing is lost or doubled. Values that don't fit their field's type are rescued.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.readers import RESCUED
from .ingest import file_stream

VERSION, BATCH = "_schema_version", "_batch"
#: Types tried for a new field, narrowest first; the first that holds all its values is taken.
CANDIDATES = (T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampNTZType())


class SchemaLog:
    """Numbered schema versions, a small JSON file each, in a folder that all runs share."""

    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.location = spark, location.rstrip("/")

    def _path(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.location}/{name}")

    def versions(self) -> dict[int, T.StructType]:
        fs = self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(self._path()):
            return {}
        found = {}
        for s in fs.listStatus(self._path()):
            name = s.getPath().getName()
            if name.startswith("v="):
                stream = fs.open(s.getPath())
                try:
                    found[int(name[2:])] = T.StructType.fromJson(json.loads(bytes(stream.readAllBytes())))
                finally:
                    stream.close()
        return dict(sorted(found.items()))

    def latest(self) -> tuple[int, T.StructType] | None:
        return max(self.versions().items(), default=None)

    def append(self, schema: T.StructType) -> int:
        """Add the next version; an error if another run has just added it."""
        number = (self.latest() or (0, None))[0] + 1
        path = self._path(f"v={number:08d}")
        try:
            out = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, False)
        except Py4JJavaError as e:
            raise RuntimeError(f"schema version {number} was added by another run") from e
        out.write(bytearray(schema.json().encode()))
        out.close()
        return number


def new_fields(batch: DataFrame, known: T.StructType) -> list[T.StructField]:
    """Rescued fields that `known` lacks, by name, each with the narrowest type that holds all its
    values. Two passes over the batch; only field names and counts reach the driver."""
    names = [r[0] for r in batch.select(F.explode(F.map_keys(RESCUED)).alias("f")).distinct()
             .where(~F.col("f").isin(known.names)).orderBy("f").collect()]
    if not names:
        return []
    value = {n: F.try_element_at(F.col(RESCUED), F.lit(n)) for n in names}
    misfits = batch.agg(*[F.count_if(value[n].isNotNull() & value[n].try_cast(t).isNull()).alias(f"{i}_{j}")
                          for i, n in enumerate(names) for j, t in enumerate(CANDIDATES)]).first()
    kind = lambda i: next((t for j, t in enumerate(CANDIDATES) if not misfits[f"{i}_{j}"]), T.StringType())
    return [T.StructField(n, kind(i)) for i, n in enumerate(names)]


def drain_evolving(spark: SparkSession, landing: str, declared: T.StructType, location: str, sink: str,
                   checkpoint: str, max_files_per_trigger: int | None = None) -> dict:
    """Drain JSON files into `sink` with the newest schema of the log at `location`, widening it as
    files bring new fields. Returns the log's version and how often the stream was restarted.

    Each micro-batch is a folder of its own that a replay replaces. A field whose name differs from
    a known one only in case is refused, as the two could not be told apart."""
    log, restarts = SchemaLog(spark, location), 0
    if log.latest() is None:
        log.append(declared)
    while True:
        number, schema = log.latest()
        widened: list[int] = []

        def per_batch(batch: DataFrame, batch_id: int, number=number, schema=schema, widened=widened) -> None:
            batch = batch.persist()
            try:
                found = new_fields(batch, schema)
                if found:
                    lower = {n.lower() for n in schema.names}
                    clash = [f.name for f in found if f.name.lower() in lower]
                    if clash:
                        raise ValueError(f"fields differ from known ones only in case: {clash}")
                    widened.append(log.append(T.StructType([*schema.fields, *found])))
                    raise RuntimeError(f"schema version {widened[-1]} begins; the stream starts again")
                (batch.withColumn(VERSION, F.lit(number)).write.mode("overwrite")
                 .parquet(f"{sink.rstrip('/')}/{BATCH}={batch_id}"))
            finally:
                batch.unpersist()

        stream = file_stream(spark, landing, schema, "json", max_files_per_trigger, rescue=True)
        q = (stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        try:
            q.awaitTermination()
        except StreamingQueryException:
            if not widened:
                raise
            restarts += 1
            continue
        return {"version": number, "restarts": restarts}


def read_sink(spark: SparkSession, location: str, sink: str) -> DataFrame:
    """All drained rows with the newest schema; fields that came later are NULL in earlier rows."""
    _, schema = SchemaLog(spark, location).latest()
    extra = [T.StructField(RESCUED, T.MapType(T.StringType(), T.StringType())), T.StructField("_corrupt_record", T.StringType()),
             T.StructField("_source_file", T.StringType()), T.StructField(VERSION, T.IntegerType())]
    return spark.read.schema(T.StructType([*schema.fields, *extra])).parquet(sink)
