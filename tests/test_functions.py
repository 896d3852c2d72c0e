import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from strata.functions import (calendar_columns, case_map, date_key, guarded_ratio, hash_bucket, mask_hash,
                              mask_prefix, row_hash, shift_days, shift_seconds, stable_id, threshold_ladder)


def test_row_hash_distinguishes_positions_nulls_separators_and_tokens(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a|", "b"), ("a", "|b"), ("~", "x"), (None, "x"),
                                ("a\\", "|b"), ("a", "\\|b")], "x string, y string")
    hs = [r.h for r in df.select(row_hash(["x", "y"]).alias("h")).collect()]
    assert len(set(hs)) == len(hs)
    same = spark.createDataFrame([("a", "b"), ("a", "b")], "x string, y string").select(row_hash(["x", "y"]).alias("h"))
    assert same.distinct().count() == 1


def test_stable_id_and_hash_bucket(spark):
    df = spark.range(1000)
    a = rows(df.select("id", stable_id(F.lit("t"), "id").alias("s")))
    b = rows(df.repartition(7).select("id", stable_id(F.lit("t"), "id").alias("s")))
    assert a == b
    buckets = df.select(hash_bucket(10, "id", salt="x").alias("b")).distinct().collect()
    assert {r.b for r in buckets} == set(range(10))
    other = rows(df.select("id", hash_bucket(10, "id", salt="y").alias("b")))
    assert other != rows(df.select("id", hash_bucket(10, "id", salt="x").alias("b")))


def test_case_map_ladder_ratio(spark):
    df = spark.createDataFrame([(0,), (1,), (5,), (None,)], "v int")
    got = rows(df.select("v", case_map("v", {0: "A", 1: "B"}, "Z").alias("c"),
                         case_map("v", {0: "A"}).alias("n"),
                         threshold_ladder("v", [(1, "LOW"), (5, "MID")], "HIGH").alias("l"),
                         guarded_ratio(F.lit(10.0), "v").alias("r")))
    assert got == [(0, "A", "A", "LOW", None), (1, "B", None, "MID", 10.0), (5, "Z", None, "HIGH", 2.0),
                   (None, "Z", None, "HIGH", None)]


def test_masks(spark):
    df = spark.createDataFrame([("TECH-123",), ("TECH-456",), (None,)], "t string")
    got = df.select(mask_prefix("t", 4).alias("p"), mask_hash("t", "k", keep=2).alias("h")).collect()
    assert [r.p for r in got] == ["TECH***", "TECH***", None]
    hs = [r.h for r in got]
    assert hs[0] != hs[1] and hs[2] is None and hs[0].startswith("TE") and hs[0].endswith("***")


def test_dates(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 12, 31, 23, 30),)], "ts timestamp_ntz")
    r = df.select(date_key("ts").alias("k"), shift_days("ts", -7).alias("d"),
                  shift_seconds("ts", 3600).alias("s"),
                  *[v.alias(n) for n, v in calendar_columns(F.to_date("ts")).items()]).first()
    assert r.k == 20241231 and r.d == dt.date(2024, 12, 24) and r.s == dt.datetime(2025, 1, 1, 0, 30)
    assert (r.y, r.q, r.m, r.dom, r.fq, r.is_year_end, r.is_month_end) == (2024, 4, 12, 31, "FQ4", True, True)
    assert r.dow == 3 and r.day_name == "Tuesday" and r.month_name == "December" and r.mon == "Dec"
