"""Dimension and fact proofs (orders / lineitem / part / customer / events)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.dates import date_key, shift_days, shift_seconds
from ..operators import asof, dated, keys, model
from ..session import scratch_path
from ..sources import writers
from .fixtures import NULL_TECHNICIAN_EVERY, part_versions
from .tables import Tables

# Fixed values of the proofs: technician naming, soft-deleted
# event type, and the multipliers that derive repeatable cost shares from the row id.
TECH_PREFIX, TECH_LEVEL = "Tech_", "LEVEL_1"
DELETED_EVENT = "error"
PARTS_MULT, LABOR_MULT, SHARE_MOD = 37, 61, 100


def sk_dense(spark, sf_dir):
    pri = Tables(spark, sf_dir).orders.select("o_orderpriority").distinct()
    return keys.assign_keys(pri, ["o_orderpriority"], "sk")


def dim_order(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("priority"),
        F.to_date("o_orderdate").alias("planned_start_date"),
        F.lit(None).cast("date").alias("planned_end_date"))
    return keys.assign_keys(o, ["order_id"], "order_sk")


def dim_from_fact(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.select(
        F.when(F.col("user_id") % NULL_TECHNICIAN_EVERY != 0, F.col("user_id")).alias("technician_id"))
    attrs = {"technician_name": F.concat(F.lit(TECH_PREFIX), F.col("technician_id").cast("string")),
             "certification_level": F.lit(TECH_LEVEL)}
    return model.dimension_from_fact(ev, "technician_id", attrs, "technician_sk")


def dim_versions(spark, sf_dir):
    v = part_versions(Tables(spark, sf_dir).part).withColumn("is_current", F.col("en").isNull())
    return keys.assign_keys(v, ["p_partkey", "ver"], "part_sk")


def fact_temporal_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = model.temporal_join(t.lineitem, part_versions(t.part), "l_partkey", "p_partkey",
                            "l_shipdate", "st", "en", half_open=True)
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "ver")


# Fixed values of the long histories: the priorities that stand for equipment, how often a version
# ends before the next one starts, and after how many days.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
GAP_EVERY, GAP_DAYS = 7, 1


def _long_history(orders):
    """A version of each priority from every day with such orders to the next; every seventh ends a
    day after its start. A few keys, thousands of versions each."""
    days = orders.groupBy(F.col("o_orderpriority").alias("priority"), F.to_date("o_orderdate").alias("st")).agg(
        F.max("o_totalprice").alias("top_price"))
    w = Window.partitionBy("priority").orderBy("st")
    nth = F.row_number().over(w)
    return days.withColumns({"ver": nth, "en": F.lead("st").over(w)}).withColumn(
        "en", F.when(F.col("ver") % GAP_EVERY == 0, F.date_add("st", GAP_DAYS)).otherwise(F.col("en")))


def fact_asof_binned(spark, sf_dir):
    """Every line with the version of its equipment on the day it was shipped, from histories of
    thousands of versions on five keys (a line without a version keeps NULLs)."""
    t = Tables(spark, sf_dir)
    which = F.element_at(F.array(*[F.lit(p) for p in PRIORITIES]), (F.col("l_orderkey") % len(PRIORITIES) + 1).cast("int"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate", which.alias("equipment"))
    j = asof.asof_join(lines, _long_history(t.orders), "equipment", "priority", "l_shipdate", "st", "en")
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "equipment", "ver", "st", "top_price")


def chk_fact_grain(spark, sf_dir):
    """Grain check on the *inclusive* interval join: driving rows matched twice."""
    t = Tables(spark, sf_dir)
    j = model.temporal_join(t.lineitem, part_versions(t.part), "l_partkey", "p_partkey",
                            "l_shipdate", "st", "en", half_open=False)
    driving = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    bad = model.grain_violations(j, driving)
    return bad.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n_extra"))


def fact_star_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    cust = t.customer.select("c_custkey", "c_nationkey")
    j = model.star_join(t.lineitem, [(orders, "l_orderkey", "o_orderkey"),
                                     (cust, "o_custkey", "c_custkey")])
    net = (F.col("l_extendedprice").cast("decimal(12,2)")
           * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,4)")
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_custkey", "c_nationkey",
                    date_key("o_orderdate").alias("date_sk"), net.alias("net"))


def fact_unknown_member(spark, sf_dir):
    t = Tables(spark, sf_dir)
    dim = t.part.filter(F.col("p_partkey") % 2 == 0).select(
        "p_partkey", (F.col("p_partkey") + 1).cast("bigint").alias("sk"))
    f = model.lookup_keys(t.orders, dim, "o_custkey", "p_partkey", "sk", on_missing="unknown")
    return f.select("o_orderkey", "sk")


def fact_maintenance(spark, sf_dir):
    t = Tables(spark, sf_dir)
    live = t.events.filter(F.col("event_type") != DELETED_EVENT)   # soft-delete filter
    j = model.star_join(live, [(t.customer.select("c_custkey", "c_nationkey"), "user_id", "c_custkey")])
    return j.select("event_id", "user_id", "c_nationkey", date_key("ts").alias("date_sk"), "value")


def cost_split(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    eid = F.col("event_id")
    c = model.split_cost(F.col("value"), (eid * PARTS_MULT) % SHARE_MOD, (eid * LABOR_MULT) % SHARE_MOD)
    return e.select("event_id", c["parts"].alias("parts_x1000"), c["labor"].alias("labor_x1000"),
                    c["total"].alias("total_x1000"))


def date_shift(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.select("o_orderkey", shift_days("o_orderdate", -7).alias("d7"),
                    shift_seconds("o_orderdate", 3600).alias("t1"))


def dim_date(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    bounds = o.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    return model.date_dimension(model.date_spine(bounds, "lo", "hi"))


# Fixed value: the first load holds the orders placed before this day.
FIRST_LOAD_BEFORE = "1997-01-01 00:00:00"


def sk_incremental(spark, sf_dir):
    """Keys of a first load stay; customers first seen later continue from max + 1."""
    o = Tables(spark, sf_dir).orders
    early = o.filter(F.col("o_orderdate") < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz"))
    k1 = keys.assign_keys(early.select("o_custkey").distinct(), ["o_custkey"], "sk")
    return keys.assign_keys(o.select("o_custkey").distinct(), ["o_custkey"], "sk", key_map=k1)


# Fixed value: the return flag that marks rejected units in the production stand-in.
REJECTED_FLAG = "R"


def fact_production(spark, sf_dir):
    """Production output per order (G8): lineitem quantities as produced units, returned
    ones as rejected; measures guarded (partial aggregation per order, then one join)."""
    t = Tables(spark, sf_dir)
    q = F.col("l_quantity")
    per_order = t.lineitem.groupBy("l_orderkey").agg(
        F.sum(q).alias("ordered"),
        F.sum(F.when(F.col("l_returnflag") == REJECTED_FLAG, q).otherwise(F.lit(0.0))).alias("rejected"))
    f = t.orders.select("o_orderkey", "o_orderdate").join(
        per_order, F.col("o_orderkey") == F.col("l_orderkey"))
    m = model.production_measures(F.col("ordered"), F.col("rejected"))
    return f.select("o_orderkey", date_key("o_orderdate").alias("date_sk"),
                    F.col("ordered").alias("units_produced"), m["units_passed"].alias("units_passed"),
                    m["defect_count"].alias("defect_count"), m["yield_on_ordered"].alias("yield_rate"))


# Fixed value: the days of the calendar that the pruned join asks for.
CHOSEN_DAYS = "fq = 'FQ4' and is_weekend"


def fact_dates_pruned(spark, sf_dir):
    """Lines stored by month of shipment and joined with chosen days of a stored date dimension: only
    those days' months are read."""
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "lines-by-month")
    dated.write_by_date(t.lineitem.select("l_orderkey", "l_quantity", "l_shipdate"), path, "l_shipdate")
    bounds = t.lineitem.agg(F.min("l_shipdate").alias("s"), F.max("l_shipdate").alias("e"))
    calendar = writers.write_snapshot(model.date_dimension(model.date_spine(bounds, "s", "e")), scratch_path(spark, "dim-date"), 1)
    j = dated.join_dates(spark.read.parquet(path), spark.read.parquet(calendar).where(CHOSEN_DAYS))
    return j.groupBy("y", "month_name", "day_name").agg(
        F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
