"""Union of frames whose columns share names but not types.

Spark's own coercion decides the least common type of a column. A value that does not fit it
(a text among numbers) is NULL there and kept as text in a map of rescued fields.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.readers import RESCUED

_NESTED = (T.StructType, T.ArrayType, T.MapType)


def common_type(spark: SparkSession, types: Sequence[T.DataType]) -> T.DataType:
    """The type Spark gives `coalesce` of columns of these types; text where there is none."""
    def meet(a: T.DataType, b: T.DataType) -> T.DataType:
        if a == b:
            return a
        if isinstance(a, T.StringType) and isinstance(b, _NESTED) or isinstance(b, T.StringType) and isinstance(a, _NESTED):
            return T.StringType()
        none = spark.createDataFrame([], T.StructType([T.StructField("a", a), T.StructField("b", b)]))
        try:
            return none.select(F.coalesce("a", "b").alias("c")).schema["c"].dataType
        except AnalysisException:
            return T.StringType()
    return reduce(meet, types)


def union_widened(frames: Sequence[DataFrame], rescued: str = RESCUED) -> DataFrame:
    """Bag union by name. Columns of one name meet at their least common type, absent columns are
    NULL, and a non-NULL value that the common type can't hold goes to the map `rescued`
    (column name -> text; NULL if nothing was rescued). A map of that name which a frame
    already has is kept; of two entries of one column the new one stays. Columns with no common type
    become text (nested ones as JSON). No frames: an error; empty frames give their columns."""
    frames = list(frames)
    if not frames:
        raise ValueError("union_widened needs at least one frame")
    spark = frames[0].sparkSession
    order = list(dict.fromkeys(c for f in frames for c in f.columns if c != rescued))
    types = {c: common_type(spark, [f.schema[c].dataType for f in frames if c in f.columns]) for c in order}
    no_fields = F.create_map().cast("map<string,string>")

    def widened(df: DataFrame) -> DataFrame:
        # inputs get names of their own: inside a lambda a name would else mean the new column
        src = {c: F.col(f"__in_{i}") for i, c in enumerate(df.columns)}
        inner = df.toDF(*[f"__in_{i}" for i in range(len(df.columns))])

        def text(c):
            return F.to_json(src[c]) if isinstance(df.schema[c].dataType, _NESTED) else src[c].cast("string")

        out, lost = {}, {}
        for c in order:
            if c not in src:
                out[c] = F.lit(None).cast(types[c])
            elif df.schema[c].dataType == types[c]:
                out[c] = src[c]
            elif isinstance(types[c], T.StringType):
                out[c] = text(c)
            else:
                out[c] = src[c].try_cast(types[c])
                lost[c] = src[c].isNotNull() & out[c].isNull()
        new = no_fields
        if lost:
            pairs = [x for c, misfit in lost.items() for x in (F.lit(c), F.when(misfit, text(c)))]
            new = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())
        if rescued in src:
            def stays(k, v):
                keep = F.lit(True)
                for c, misfit in lost.items():
                    keep = keep & ~((k == F.lit(c)) & misfit)
                return keep

            old = F.coalesce(src[rescued].cast("map<string,string>"), no_fields)
            new = F.map_concat(F.map_filter(old, stays), new)
        return inner.select(*[e.alias(c) for c, e in out.items()], F.when(F.size(new) > 0, new).alias(rescued))

    return reduce(lambda a, b: a.unionByName(b), [widened(f) for f in frames])
