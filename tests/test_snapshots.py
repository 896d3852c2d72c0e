import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from strata.operators import changes as C
from strata.operators import snapshots as S

T0 = dt.datetime(2024, 1, 1)
PLAN = lambda cur, b: C.apply_changes(cur, b, ["k"], value_cols=["value"])


def _base(spark):
    return spark.range(200).select(F.col("id").cast("string").alias("k"), F.lit(1.0).alias("value"),
                                   F.lit(T0).cast("timestamp_ntz").alias("ts"), F.col("id").alias("lsn"),
                                   F.lit(False).alias("is_deleted"))


def _batch(spark, lsn):
    return spark.createDataFrame([("5", 9.0, T0 + dt.timedelta(1), lsn, "UPDATE"), ("new", 3.0, T0, lsn + 1, "INSERT"),
                                  (None, 4.0, T0, lsn + 2, "INSERT")],
                                 "k string, value double, ts timestamp_ntz, lsn long, op string")


def test_advance_equals_the_plan_and_keeps_old_versions(spark, scratch):
    base, path = _base(spark), scratch("state")
    assert S.read(spark, path, base.schema).count() == 0          # nothing written yet
    S.advance(spark, path, base, lambda cur, b: b, base.schema)
    S.advance(spark, path, _batch(spark, 1000), PLAN, base.schema)
    assert rows(S.read(spark, path, base.schema)) == rows(PLAN(base, _batch(spark, 1000)))
    assert S.read(spark, path, base.schema, at_most=0).count() == 200
    assert S.versions(spark, path) == [0, 1]


def test_replayed_batch_replaces_its_own_version(spark, scratch):
    base, path = _base(spark), scratch("state")
    S.advance(spark, path, base, lambda cur, b: b, base.schema, version=0)
    for _ in range(2):
        S.advance(spark, path, _batch(spark, 1000), PLAN, base.schema, version=1)
    assert S.read(spark, path, base.schema).count() == 202         # the NULL key is one row


def test_half_written_version_is_not_read(spark, scratch):
    base, path = _base(spark), scratch("state")
    S.advance(spark, path, base, lambda cur, b: b, base.schema)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    base.limit(3).write.parquet(f"{path}/v=00000001")
    mark = hadoop(f"{path}/v=00000001/_SUCCESS")
    mark.getFileSystem(spark._jsc.hadoopConfiguration()).delete(mark, False)
    assert S.read(spark, path, base.schema).count() == 200
    assert S.advance(spark, path, _batch(spark, 1000), PLAN, base.schema) == 1
