"""Readers with declared schemas, file lineage and rescued fields.

Schemas are declared rather than inferred (inference is a second full scan and guesses
types). JSON can be read in *rescue* mode: well-typed known fields become columns,
unknown keys and values that do not fit their declared type go to `_rescued_data`
(a map), and lines that are not JSON at all go to `_corrupt_record` — nothing is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"
CORRUPT = "_corrupt_record"


def read(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None,
         **options) -> DataFrame:
    """Batch read of any file format (parquet default; `delta` etc. if installed)."""
    r = spark.read.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True,
             **options) -> DataFrame:
    return spark.read.options(header=str(header).lower(), **options).schema(schema).csv(path)


def infer_schema(spark: SparkSession, path: str, fmt: str = "json", sampling_ratio: float = 1.0) -> T.StructType:
    """Inference kept as a helper for exploration (one extra scan); pipelines declare."""
    return spark.read.format(fmt).option("samplingRatio", sampling_ratio).load(path).schema


def with_lineage(df: DataFrame, ingest_ts: Column | None = None, extended: bool = False,
                 source_name: str | None = None) -> DataFrame:
    """`_source_file` from the hidden file metadata (or a literal for table sources),
    `_ingestion_timestamp` (injectable for reproducible tests), optional file details."""
    cols = {"_ingestion_timestamp": ingest_ts if ingest_ts is not None else F.current_timestamp()}
    if source_name is not None:
        cols["_source_file"] = F.lit(source_name)
    else:
        cols["_source_file"] = F.col("_metadata.file_path")
        if extended:
            cols["_source_file_name"] = F.col("_metadata.file_name")
            cols["_source_file_size"] = F.col("_metadata.file_size")
            cols["_source_file_mtime"] = F.col("_metadata.file_modification_time")
    return df.withColumns(cols)


def parse_json_rescued(text: DataFrame, schema: T.StructType, value_col: str = "value",
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns from JSON text plus `_rescued_data` / `_corrupt_record`."""
    raw = F.col(value_col)
    parsed = F.from_json(raw, schema)
    as_map = F.from_json(raw, T.MapType(T.StringType(), T.StringType()))
    known = {f.name for f in schema.fields}
    typed_as_text = F.create_map(*[x for f in schema.fields
                                   for x in (F.lit(f.name), F.col("__p")[f.name].cast("string"))])
    rescued = F.map_filter(
        F.col("__m"),
        lambda k, v: ~F.array_contains(F.lit(sorted(known)), k)
        | (v.isNotNull() & F.try_element_at(F.col("__tm"), k).isNull()))
    out = (text.select(*keep, raw.alias("__raw"), parsed.alias("__p"), as_map.alias("__m"))
           .withColumn("__tm", typed_as_text))
    return out.select(
        *[F.col("__p")[f.name].alias(f.name) for f in schema.fields],
        F.when(F.col("__m").isNotNull() & (F.size(rescued) > 0), rescued).alias(RESCUED),
        F.when(F.col("__m").isNull(), F.col("__raw")).alias(CORRUPT),
        *keep,
    )


def conform_rescued(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns of `schema` from a frame that may have others: unknown columns, and values
    that do not fit their declared type, go to `_rescued_data` as text."""
    have = [c for c in df.columns if c not in keep]
    typed = {f.name: F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)
             for f in schema.fields}

    def as_text(c):
        plain = F.col(c).cast("string") if not isinstance(df.schema[c].dataType, (T.StructType, T.ArrayType, T.MapType)) \
            else F.to_json(c)
        lost = typed[c].isNull() if c in typed else F.lit(True)
        return F.when(lost, plain)

    pairs = [x for c in have for x in (F.lit(c), as_text(c))]
    rescued = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())
    return df.select(*[e.alias(n) for n, e in typed.items()],
                     F.when(F.size(rescued) > 0, rescued).alias(RESCUED), *keep)


def read_json_rescued(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines read as text, then parsed with rescue (file lineage preserved)."""
    text = spark.read.text(path).withColumn("_source_file", F.col("_metadata.file_path"))
    return parse_json_rescued(text, schema, keep=("_source_file",))


def promote_rescued(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Schema evolution: turn rescued keys into typed columns (`{"name": "type"}`) and
    drop them from `_rescued_data`; a value that does not cast stays rescued."""
    rescued = F.col(RESCUED)
    out = df.withColumns({n: F.try_element_at(rescued, F.lit(n)).try_cast(t) for n, t in fields.items()})

    def stays(k, v):
        failed = [(k == F.lit(n)) & v.isNotNull() & v.try_cast(t).isNull() for n, t in fields.items()]
        cond = ~k.isin(*fields.keys())
        for f in failed:
            cond = cond | f
        return cond

    left = F.map_filter(rescued, stays)
    return out.withColumn(RESCUED, F.when(F.size(left) > 0, left))


def schema_drift(df: DataFrame, expected: T.StructType) -> dict:
    """Columns added, missing, or with a different type versus the expected schema."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in expected.fields}
    return {"added": sorted(set(have) - set(want)), "missing": sorted(set(want) - set(have)),
            "retyped": sorted(k for k in set(have) & set(want) if have[k] != want[k])}
