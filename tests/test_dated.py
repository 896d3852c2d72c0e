"""Facts by date: computed period keys, and only the asked periods read."""
import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from strata.operators import dated, model


def _stored(spark, path, period):
    days = spark.range(400).select("id", F.date_add(F.lit(dt.date(2023, 1, 1)), F.col("id").cast("int")).alias("d"))
    df = days.unionByName(spark.createDataFrame([(1000, None)], "id bigint, d date"))
    dated.write_by_date(df, path, "d", period=period)
    return spark.read.parquet(path)


def _calendar(spark, path, start, end):
    bounds = spark.createDataFrame([(start, end)], "s date, e date")
    model.date_dimension(model.date_spine(bounds, "s", "e")).write.parquet(path)
    return spark.read.parquet(path)


def test_period_keys(spark):
    got = spark.createDataFrame([(20240229,), (None,)], "k int").select(
        *[dated.period_key("k", p).alias(p) for p in ("day", "month", "year")])
    assert rows(got) == [(20240229, 202402, 2024), (None, None, None)]


def test_join_reads_only_the_periods_of_the_chosen_days(spark, scratch):
    calendar = _calendar(spark, scratch("dates"), dt.date(2022, 12, 1), dt.date(2024, 12, 31))
    j = dated.join_dates(_stored(spark, scratch("fact"), "month"), calendar.where("y = 2023 and m in (3, 5) and dom = 2"))
    assert sorted(r.id for r in j.collect()) == [60, 121]
    final = j._jdf.queryExecution().executedPlan().executedPlan().plan()     # the stage of the result
    assert "dynamicpruning" in final.toString()
    leaves = final.collectLeaves()
    read = [leaves.apply(i).metrics().get("numPartitions") for i in range(leaves.size())]
    assert [m.get().value() for m in read if m.isDefined()] == [2]           # of 15


def test_other_periods(spark, scratch):
    calendar = _calendar(spark, scratch("dates"), dt.date(2022, 12, 1), dt.date(2024, 12, 31))
    for period in ("day", "year"):
        fact = _stored(spark, scratch("fact"), period)
        j = dated.join_dates(fact, calendar.where("y = 2023 and m in (3, 5) and dom = 2"), period=period)
        assert sorted(r.id for r in j.collect()) == [60, 121]


def test_rows_without_a_date_meet_no_day(spark, scratch):
    fact = _stored(spark, scratch("fact"), "month")
    assert fact.where("date_sk is null").count() == 1
    calendar = _calendar(spark, scratch("dates"), dt.date(2023, 1, 1), dt.date(2024, 12, 31))
    j = dated.join_dates(fact, calendar)
    assert j.count() == 400 and "date_sk" in j.columns and "timestamp_sk" not in j.columns


def test_empty_fact(spark, scratch):
    path = scratch("fact")
    dated.write_by_date(spark.createDataFrame([], "id bigint, d date"), path, "d")
    empty = spark.createDataFrame([], "id bigint, d date, date_sk int, date_sk_month int")
    calendar = _calendar(spark, scratch("dates"), dt.date(2023, 1, 1), dt.date(2023, 1, 2))
    assert dated.join_dates(empty, calendar).count() == 0
