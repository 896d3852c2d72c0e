"""Late rows: routed by the watermark in force, nothing lost, replays add nothing."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strata.context import RunContext
from strata.operators.report import Ledger
from strata.streaming import late, observe

SCHEMA = "k bigint, ts timestamp"


def _at(hour):
    return None if hour is None else dt.datetime(2024, 1, 1) + dt.timedelta(hours=hour)


class Landing:
    def __init__(self, spark, scratch):
        self.spark, self.landing, self.out, self.ckpt = spark, scratch("landing"), scratch("out"), scratch("ckpt")

    def load(self, *data):
        self.spark.createDataFrame([(k, _at(h)) for k, h in data], SCHEMA).coalesce(1).write.mode("append").parquet(self.landing)
        src = self.spark.readStream.schema(SCHEMA).parquet(self.landing)
        late.drain_with_late(src, ["k"], "ts", "1 hour", self.out, self.ckpt)

    def kept(self):
        return [k for k, in rows(self.spark.read.parquet(f"{self.out}/kept"), "k")]

    def late(self):
        return rows(late.late_rows(self.spark, self.out, self.spark.createDataFrame([], SCHEMA).schema), "k", "batch")


def test_late_rows_and_rows_without_time_are_routed(spark, scratch):
    s = Landing(spark, scratch)
    s.load((1, 10), (2, 2), (3, None))               # first batch: no watermark yet
    s.load((1, 10), (4, 9), (5, 9.5), (6, 20))       # watermark at 9: the row on it is late
    s.load((5, 9.5), (7, 19.5), (6, 20))             # watermark at 19: a late copy counts as late
    assert s.kept() == [1, 2, 5, 6, 7]
    assert s.late() == [(3, 0), (4, 1), (5, 2)]
    seen = rows(late.marks(spark, s.out), "batch", "on_time", "late")
    assert seen == [(0, 2, 1), (1, 3, 1), (2, 2, 1)]
    landed = spark.read.parquet(s.landing).count()
    duplicates = sum(n for _, n, _ in seen) - len(s.kept())
    assert landed == len(s.kept()) + len(s.late()) + duplicates == 10


def test_state_forgets_keys_behind_the_watermark(spark, scratch):
    s = Landing(spark, scratch)
    s.load((1, 1), (2, 2))
    s.load((3, 100), (4, 99.5))
    assert rows(late.held_keys(spark, s.ckpt, ["k"])) == [(3,), (4,)]


def test_batch_of_late_rows_only_and_nothing_new(spark, scratch):
    s = Landing(spark, scratch)
    s.load((1, 100))
    s.load((2, 1), (3, None))
    src = spark.readStream.schema(SCHEMA).parquet(s.landing)
    late.drain_with_late(src, ["k"], "ts", "1 hour", s.out, s.ckpt)
    assert s.kept() == [1] and s.late() == [(2, 1), (3, 1)]


def test_replayed_batch_adds_nothing(spark, scratch):
    s = Landing(spark, scratch)
    s.load((1, 10), (2, 9))
    # the split's checkpoint is lost: the batch comes again under the same number
    src = spark.readStream.schema(SCHEMA).parquet(s.landing)
    other = scratch("ckpt")
    late.drain_with_late(src, ["k"], "ts", "1 hour", s.out, other)
    assert late.marks(spark, s.out).count() == 1
    assert spark.read.parquet(f"{s.out}/landed").count() == 2


def test_every_batch_is_in_the_ledger(spark, scratch):
    path = scratch("landing")
    spark.range(40).selectExpr("id", "nullif(id % 4, 3) as v").repartition(4).write.parquet(path)
    src = spark.readStream.schema("id bigint, v bigint").option("maxFilesPerTrigger", 1).parquet(path)
    ledger = Ledger(RunContext(run_id="r"))
    observe.drain_observed(src, F.col("v") > 0, scratch("sink"), scratch("ckpt"), ledger, "bronze")
    got = ledger.to_df(spark)
    assert got.count() == 4 and got.agg(F.sum("rows_in"), F.sum("rows_out")).first() == (40, 20)
    assert rows(got, "step") == [(f"bronze/{i}",) for i in range(4)]


def test_failed_drain_is_in_the_ledger(spark, scratch):
    path = scratch("landing")
    spark.range(4).repartition(1).write.parquet(path)
    src = spark.readStream.schema("id bigint").parquet(path).withColumn("x", F.raise_error(F.lit("no")).cast("int"))
    ledger = Ledger(RunContext(run_id="r"))
    with pytest.raises(Exception):
        observe.drain_observed(src, F.col("id") > 0, scratch("sink"), scratch("ckpt"), ledger, "bronze")
    assert [r[:2] for r in ledger.rows] == [("bronze", "FAILED")]
