"""A schema inferred from a sample, held against the declared one over all rows.

Inference on a sample says what a source looks like; only the whole data says whether the declared
types hold. One pass reads each JSON line as a map of texts and counts, for every field that
occurs, its values and those that don't fit the declared type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.widen import common_type
from . import readers

REPORT = "field string, declared string, inferred string"


def _proposed(spark: SparkSession, declared: T.DataType | None, inferred: T.DataType | None) -> str:
    """Type to declare where values don't fit: what both meet at; text where the sample has text."""
    if declared is None or inferred is None or isinstance(inferred, T.StringType):
        return (inferred or T.StringType()).simpleString()
    return common_type(spark, [declared, inferred]).simpleString()


def drift_report(spark: SparkSession, path: str, declared: T.StructType, sampling_ratio: float = 0.1) -> DataFrame:
    """field, declared, inferred, verdict, proposed, n_values, n_misfits: a row per field.

    verdict: `absent` (declared, no value anywhere), `undeclared`, `misfits` (values that the
    declared type can't hold), `same`, or `fits` (another type was inferred, yet every value fits).
    `inferred` is NULL for a field that the sample missed. Lines that are no JSON object count nowhere.
    Nested declared fields are held to be text."""
    seen = {f.name: f.dataType for f in readers.infer_schema(spark, path, "json", sampling_ratio).fields
            if f.name != readers.CORRUPT}
    want = {f.name: f.dataType for f in declared.fields}
    names = sorted({*seen, *want})
    types = spark.createDataFrame(
        [(n, want[n].simpleString() if n in want else None, seen[n].simpleString() if n in seen else None,
          _proposed(spark, want.get(n), seen.get(n))) for n in names], f"{REPORT}, other string")
    misfit = F.lit(False)
    for name, kind in want.items():
        if not isinstance(kind, (T.StringType, T.StructType, T.ArrayType, T.MapType)):
            misfit = F.when(F.col("name") == name, F.col("value").try_cast(kind).isNull()).otherwise(misfit)
    lines = spark.read.text(path).select(F.from_json("value", "map<string,string>").alias("m"))
    counted = (lines.select(F.explode("m").alias("name", "value")).where(F.col("value").isNotNull())
               .groupBy("name").agg(F.count("*").alias("n_values"), F.count_if(misfit).alias("n_misfits")))
    n = F.coalesce("n_values", F.lit(0).cast("bigint"))
    bad = F.coalesce("n_misfits", F.lit(0).cast("bigint"))
    verdict = (F.when(F.col("declared").isNull(), "undeclared").when(n == 0, "absent").when(bad > 0, "misfits")
               .when(F.col("declared") == F.col("inferred"), "same").otherwise("fits"))
    both = types.join(counted, F.col("field") == F.col("name"), "full")
    return both.select(F.coalesce("field", "name").alias("field"), "declared", "inferred", verdict.alias("verdict"),
                       F.when(verdict.isin("misfits", "undeclared"), F.coalesce("other", F.lit("string")))
                       .otherwise(F.col("declared")).alias("proposed"), n.alias("n_values"), bad.alias("n_misfits"))


def reconciled(report: DataFrame) -> T.StructType:
    """The schema that the report proposes, which holds every value (a row per field is collected)."""
    return T._parse_datatype_string(", ".join(
        f"`{r['field'].replace('`', '``')}` {r['proposed']}" for r in report.orderBy("field").collect()))
