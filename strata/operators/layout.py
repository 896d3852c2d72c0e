"""File layout: clustering (so readers skip files by min/max footers) and compaction of small
files. Both rewrite to a *new* path; the old one stays readable.

Clustering is Spark's own range partitioning on the columns, whole values, then a sort inside
each file. A space-filling curve over several columns is the storage engine's work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cluster(df: DataFrame, cols: Sequence[str], n_files: int) -> DataFrame:
    """Rows reordered so that each output file covers a range of `cols` (first column first).
    A row hash follows the columns in the range key, so one hot value still spreads over files."""
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    return (df.withColumn("__t", spread).repartitionByRange(n_files, *cols, "__t")
            .sortWithinPartitions(*cols).drop("__t"))


def compact(df: DataFrame, n_files: int) -> DataFrame:
    """Fewer, larger files: a plain even repartition (no key, so no skew)."""
    return df.repartition(n_files)


def files_for_target(size_bytes: int, target_bytes: int = 128 * 1024 * 1024) -> int:
    return max(1, -(-size_bytes // target_bytes))


def compact_path(spark, src: str, dst: str, target_bytes: int = 128 * 1024 * 1024,
                 fmt: str = "parquet") -> int:
    """Rewrite a folder of small files into files of about `target_bytes` at a new path.

    The input size comes from the file system's content summary (metadata only: no data
    is read to size the job); returns the number of output files requested.
    """
    df = spark.read.format(fmt).load(src)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(src)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    total = fs.getContentSummary(jpath).getLength()
    n = files_for_target(int(total), target_bytes)
    compact(df, n).write.format(fmt).mode("errorifexists").save(dst)
    return n


def file_ranges(df_read_back: DataFrame, col: str) -> DataFrame:
    """Per output file: min and max of `col` (what a reader's footer skipping sees)."""
    return (df_read_back.groupBy(F.col("_metadata.file_path").alias("file"))
            .agg(F.min(col).alias("lo"), F.max(col).alias("hi")))


def files_touching(df_read_back: DataFrame, col: str, value) -> int:
    r = file_ranges(df_read_back, col)
    return r.filter((F.col("lo") <= F.lit(value)) & (F.col("hi") >= F.lit(value))).count()
