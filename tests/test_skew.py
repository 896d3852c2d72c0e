"""One key holding a third of the rows: the plans must split it, not pin one task."""
import datetime as dt

from pyspark.sql import functions as F

from strata.operators import model
from strata.sources import writers

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


class conf:
    def __init__(self, spark, values):
        self.spark, self.values, self.old = spark, values, {}

    def __enter__(self):
        for k, v in self.values.items():
            self.old[k] = self.spark.conf.get(k, None)
            self.spark.conf.set(k, v)

    def __exit__(self, *a):
        for k, v in self.old.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)


def _facts(spark, n=30000):
    return spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997).alias("fk"),
        F.lit(dt.date(2021, 6, 1)).alias("d"), F.rand(7).alias("pad"))


def test_temporal_join_hot_key_is_split(spark):
    versions = spark.range(997).select(F.col("id").alias("dk"), F.lit(dt.date(2020, 1, 1)).alias("st"),
                                       F.lit(None).cast("date").alias("en"))
    with conf(spark, SKEW_CONF):
        j = model.temporal_join(_facts(spark), versions, "fk", "dk", "d", "st", "en")
        qe = j._jdf.queryExecution()
        qe.toRdd().count()                      # run this plan, so AQE finalizes it
        plan = qe.executedPlan().toString()
        assert "SortMergeJoin" in plan and "skew=true" in plan
        assert j.count() == 30000


def test_partitioned_write_splits_hot_value(spark, scratch):
    p = scratch("hotpart")
    df = _facts(spark).withColumn("facility", F.when(F.col("fk") == 0, "HOT").otherwise("COLD"))
    with conf(spark, SKEW_CONF):
        writers.write_partitioned(df, p, ["facility"], mode="overwrite")
    files = (spark.read.parquet(p).filter("facility = 'HOT'")
             .select("_metadata.file_path").distinct().count())
    assert files > 1
    assert spark.read.parquet(p).count() == 30000
