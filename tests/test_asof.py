"""Binned as-of joins equal the plain range join."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strata.operators.asof import asof_join
from strata.operators.model import temporal_join

D = dt.date(2024, 1, 1)
day = lambda n: D + dt.timedelta(days=n)


def history(seed, keys=4, versions=40):
    r, out = random.Random(seed), []
    for k in range(keys):
        at = r.randint(-400, 0)
        for v in range(r.randint(0, versions)):
            end = at + r.choice([1, 1, 2, 15, 16, 17, 90])
            out.append((k, v, day(at), day(end - r.choice([0, 0, 0, 1]))))     # some gaps, some empty versions
            at = end
        if r.random() < 0.7:
            out.append((k, 999, day(at), None))
    return out


def frames(spark, seed):
    r = random.Random(seed + 100)
    facts = [(i, r.choice([0, 0, 0, 1, 2, 3, 77, None]), r.choice([None, *[day(r.randint(-500, 500))] * 9]), i) for i in range(400)]
    facts += facts[:20]
    return (spark.createDataFrame(facts, "id int, k int, d date, v int"),
            spark.createDataFrame(history(seed), "k2 int, v int, st date, en date"))


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("bin_days", [1, 16, 1000])
def test_equals_the_range_join(spark, seed, how, bin_days):
    facts, versions = frames(spark, seed)
    want = temporal_join(facts, versions.filter("en is null or en > st").select("k2", F.col("v").alias("ver"), "st", "en"),
                         "k", "k2", "d", "st", "en", how=how)
    got = asof_join(facts, versions.withColumnRenamed("v", "ver"), "k", "k2", "d", "st", "en", how=how, bin_days=bin_days)
    assert got.columns == [*facts.columns, "k2", "ver", "st", "en"]
    assert rows(got, "id", "k", "d", "ver", "st", "en") == rows(want, "id", "k", "d", "ver", "st", "en")


def test_a_long_history_does_not_multiply(spark):
    """A thousand versions on one key: what meets before the range filter stays a few rows a fact."""
    versions = spark.range(1000).selectExpr("'eq' as k2", "cast(id as int) as ver", "date_add(date'2020-01-01', cast(id as int)) as st",
                                            "date_add(date'2020-01-01', cast(id + 1 as int)) as en")
    facts = spark.range(3000).selectExpr("id", "'eq' as k", "date_add(date'2020-01-01', cast(id % 1000 as int)) as d")
    got = asof_join(facts, versions, "k", "k2", "d", "st", "en", bin_days=4)
    assert got.where("ver = id % 1000").count() == got.count() == 3000
    joined = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in joined and "NestedLoop" not in joined


def test_timestamps_and_empty_sides(spark):
    facts, versions = frames(spark, 1)
    assert asof_join(facts.where("false"), versions, "k", "k2", "d", "st", "en").count() == 0
    assert asof_join(facts, versions.where("false"), "k", "k2", "d", "st", "en", how="inner").count() == 0
    assert asof_join(facts, versions.where("false"), "k", "k2", "d", "st", "en").count() == facts.count()
    stamped = facts.withColumn("d", F.col("d").cast("timestamp") + F.expr("interval 23 hours"))
    assert rows(asof_join(stamped, versions, "k", "k2", "d", "st", "en"), "id", "st") == \
        rows(asof_join(facts, versions, "k", "k2", "d", "st", "en"), "id", "st")
    with pytest.raises(ValueError):
        asof_join(facts, versions, "k", "k2", "d", "st", "en", how="full_outer")
