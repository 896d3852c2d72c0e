"""The SQL path a notebook user takes: library frames published as views, queried with
Spark SQL (views, a SQL scope function inside a view, INSERT-style conformance)."""
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL, rows
from strata.operators import governance as G
from strata.operators import model
from strata.sources import writers


def test_sql_date_dimension_equals_library(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    G.publish_view(spark, "orders_v", o)
    sql = spark.sql("""
      select d as date_day, cast(date_format(d,'yyyyMMdd') as int) as timestamp_sk, year(d) as y,
             quarter(d) as q, month(d) as m, day(d) as dom, (month(d) = 12 and day(d) = 31) as is_year_end,
             date_format(d,'MMMM') as month_name, date_format(d,'MMM') as mon, weekofyear(d) as w,
             dayofweek(d) as dow, date_format(d,'EEEE') as day_name, dayofweek(d) in (1,7) as is_weekend,
             d = last_day(d) as is_month_end, concat('FQ', quarter(d)) as fq
      from (select explode(sequence(to_date(min(o_orderdate)), to_date(max(o_orderdate)), interval 1 day)) as d
            from orders_v)""")
    bounds = o.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    lib = model.date_dimension(model.date_spine(bounds, "lo", "hi"))
    assert rows(sql) == rows(lib.select(*sql.columns))


def test_view_with_scope_function(spark):
    user = spark.sql("select current_user() as u").first().u
    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    G.publish_view(spark, "customer_v", c)
    G.register_scope_function(spark, "my_nation", {user: "3"})
    spark.sql("create or replace temporary view customer_scoped as "
              "select * from customer_v where cast(c_nationkey as string) = my_nation()")
    n = spark.sql("select count(*) as n from customer_scoped").first().n
    assert n == c.filter("c_nationkey = 3").count()


def test_insert_style_conform_then_sql(spark):
    s = spark.read.parquet(f"{SF_SMALL}/supplier.parquet").select(
        F.col("s_suppkey").alias("equipment_id"), F.col("s_acctbal").alias("asset_value"))
    target = T.StructType([T.StructField("equipment_id", T.StringType()),
                           T.StructField("asset_value", T.DecimalType(12, 2)),
                           T.StructField("effective_end_date", T.DateType())])
    G.publish_view(spark, "equipment_v", writers.conform(s, target))
    r = spark.sql("select count(*) as n, count(effective_end_date) as ended, "
                  "typeof(max(asset_value)) as t from equipment_v").first()
    assert r.n == s.count() and r.ended == 0 and r.t == "decimal(12,2)"
