from conftest import SF_SMALL
from strata.operators import model
from strata.sources import writers


def test_bucketed_tables_join_without_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
        o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
        writers.write_bucketed(li, "li_b", ["l_orderkey"], 8)
        writers.write_bucketed(o.withColumnRenamed("o_orderkey", "l_orderkey"), "o_b", ["l_orderkey"], 8)
        j = spark.table("li_b").join(spark.table("o_b"), "l_orderkey")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == li.join(o, li.l_orderkey == o.o_orderkey).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_star_join_leaves_the_strategy_to_spark(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_custkey")
    j = model.star_join(li, [(o, "l_orderkey", "o_orderkey")])
    assert "strategy=broadcast" not in j._jdf.queryExecution().optimizedPlan().toString()
    assert j.count() == li.count()
