"""Gold facts and entity cleansing on the driver tables, through the same builders and rule sets
that landed entities use (events as telemetry and maintenance, orders and lineitem as
production orders and inspections, part as versioned equipment)."""

from __future__ import annotations

import datetime as _dt
from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import rulesets, starschema
from ..context import RunContext
from ..functions.dates import date_key
from ..operators import allocator, history, model
from ..session import scratch_path
from ..sources.writers import RUN_COL
from .fixtures import NULL_DEVICE_EVERY, NULL_FACILITY_EVERY, NULL_TECHNICIAN_EVERY
from .tables import Tables

CTX = RunContext(run_id="gold-1", as_of=_dt.datetime(2026, 3, 1))
# The day every third equipment changed, the shift that leaves some orders
# without known equipment, the number of technicians and the soft-deleted event type.
EQUIPMENT_FROM, EQUIPMENT_CHANGE = "1900-01-01", "2024-01-16"
EQUIPMENT_SHIFT, TECHNICIANS, DELETED_EVENT = 1000, 7, "error"
# Where the second load of a fact begins, the bounds of the three loads of lines, and
# which equipment the broken star's dimension has lost.
SECOND_LOAD_EVENTS, SECOND_LOAD_ORDERS = "2024-01-16 00:00:00", "1997-01-01 00:00:00"
LINE_LOADS = ("1996-06-01 00:00:00", "1999-01-01 00:00:00")
LOST_EQUIPMENT = 5


def equipment(t: Tables) -> DataFrame:
    p = t.part
    changed = F.col("p_partkey") % 3 == 0
    cols = [F.col("p_partkey").cast("string").alias("equipment_id"), F.lit("F").alias("facility_id"),
            F.col("p_type").alias("equipment_type"), F.col("p_brand").alias("manufacturer"),
            F.col("p_name").alias("model_number"), F.lit("ACTIVE").alias("equipment_status"),
            F.lit("LOW").alias("criticality_level"), F.col("p_retailprice").alias("asset_value_usd")]
    day = lambda s: F.lit(s).cast("date")
    v1 = p.select(*cols, day(EQUIPMENT_FROM).alias(history.START), F.when(changed, day(EQUIPMENT_CHANGE)).alias(history.END),
                  (~changed).alias(history.CURRENT), F.lit(1).alias(history.VERSION))
    v2 = p.filter(changed).select(*cols, day(EQUIPMENT_CHANGE).alias(history.START), F.lit(None).cast("date").alias(history.END),
                                  F.lit(True).alias(history.CURRENT), F.lit(2).alias(history.VERSION))
    return v1.unionByName(v2)


def telemetry(t: Tables) -> DataFrame:
    v = F.col("value")
    return t.events.select(
        "event_id", F.concat(F.lit("DEV-"), F.col("user_id").cast("string")).alias("device_id"),
        F.col("ts").alias("event_timestamp"), F.col("event_type").alias("facility_id"),
        F.col("event_type").alias("equipment_type"), v.alias("temperature"), (v / 3).alias("vibration_x"),
        (v / 4).alias("vibration_y"), v.alias("pressure"), v.alias("power_consumption"),
        F.col("event_id").alias("rpm"), F.col("user_id").cast("string").alias("equipment_id"))


def production_orders(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_orderpriority").alias("facility_id"),
        F.col("o_orderstatus").alias("product_sku"), F.floor("o_totalprice").cast("int").alias("quantity_ordered"),
        F.col("o_orderdate").alias("start_time"),
        (F.col("o_custkey") + EQUIPMENT_SHIFT).cast("string").alias("equipment_id"),
        F.col("o_orderpriority").alias("priority"))


def inspections(t: Tables) -> DataFrame:
    q = F.col("l_quantity")
    per = t.lineitem.groupBy("l_orderkey").agg(
        F.sum(q).cast("int").alias("units_inspected"),
        F.sum(F.when(F.col("l_returnflag") == "R", q).otherwise(0.0)).cast("int").alias("units_rejected"))
    return per.select(F.concat(F.lit("I"), F.col("l_orderkey").cast("string")).alias("inspection_id"),
                      F.col("l_orderkey").cast("string").alias("order_id"), "units_inspected", "units_rejected",
                      (F.col("units_inspected") - F.col("units_rejected")).alias("units_passed"))


def maintenance(t: Tables) -> DataFrame:
    e = F.col("event_id")
    tech = F.concat(F.lit("T"), (F.col("user_id") % TECHNICIANS).cast("string"))
    return t.events.select(
        e.cast("string").alias("maintenance_id"), F.col("user_id").cast("string").alias("equipment_id"),
        F.col("event_type").alias("facility_id"), F.lit("CORRECTIVE").alias("maintenance_type"),
        F.when(e % NULL_TECHNICIAN_EVERY != 0, tech).alias("maintenance_technician_id"),
        F.col("ts").alias("start_datetime"), (e % 100).cast("int").alias("downtime_minutes"),
        F.lit("FC").alias("failure_code"), F.col("value").alias("maintenance_cost_usd"),
        (F.col("event_type") == DELETED_EVENT).alias("is_deleted"))


def _appended(spark, name: str, loads: dict[str, DataFrame]) -> DataFrame:
    """The fact written in several runs, each above the keys of those before, and read back."""
    path, high_water = scratch_path(spark, name), scratch_path(spark, f"{name}-keys")
    for run_id, fact in loads.items():
        starschema.append_fact(fact, name, path, high_water, replace(CTX, run_id=run_id))
    return spark.read.parquet(path)


def _keys_once(fact: DataFrame, sk: str) -> DataFrame:
    """`key_uses`: how many rows of the whole table, over all runs, have the row's key."""
    return fact.withColumn("key_uses", F.count(F.lit(1)).over(Window.partitionBy(sk))).withColumnRenamed(RUN_COL, "run_id")


def _before(column: str, day: str):
    return F.col(column) < F.lit(day).cast("timestamp_ntz")


def gold_fact_sensor(spark, sf_dir):
    """Readings appended in two loads, with every measure and dimension key."""
    t = Tables(spark, sf_dir)
    tel = telemetry(t)
    eq, fac = starschema.dim_equipment(equipment(t)), starschema.dim_facility(tel, CTX)
    build = lambda rows: starschema.fact_sensor_readings(rows, eq, fac, CTX, "equipment_id", first_sk=None)
    early = _before("event_timestamp", SECOND_LOAD_EVENTS)
    f = _keys_once(_appended(spark, "fact_sensor_readings", {
        "load-1": build(tel.where(early)), "load-2": build(tel.where(~early))}), "sensor_reading_sk")
    return f.select("run_id", "key_uses", "equipment_sk", "facility_sk", "timestamp_sk", "temperature", "vibration_x",
                    "vibration_y", "device_id", "equipment_type", "pressure", "power_consumption", "rpm")


def gold_fact_production(spark, sf_dir):
    """Production output appended in two loads, with every measure and dimension key."""
    t = Tables(spark, sf_dir)
    orders, insp = production_orders(t), inspections(t)
    dims = (starschema.dim_production_order(orders, CTX), starschema.dim_equipment(equipment(t)), starschema.dim_facility(orders, CTX))
    build = lambda rows: starschema.fact_production_output(rows, insp, *dims, CTX, first_sk=None)
    early = _before("start_time", SECOND_LOAD_ORDERS)
    f = _keys_once(_appended(spark, "fact_production_output", {
        "load-1": build(orders.where(early)), "load-2": build(orders.where(~early))}), "production_sk")
    return f.select("run_id", "key_uses", "order_sk", "equipment_sk", "facility_sk", "timestamp_sk", "units_produced",
                    "units_passed", "units_rejected", "defect_count", "defect_rate", "yield_rate")


def _maintenance_star(t: Tables):
    m = maintenance(t)
    dims = {"dim_equipment": starschema.dim_equipment(equipment(t)), "dim_technician": starschema.dim_technician(m, CTX),
            "dim_facility": starschema.dim_facility(m, CTX)}
    build = lambda rows: starschema.fact_maintenance_events(rows, *dims.values(), CTX, first_sk=None)
    early = _before("start_datetime", SECOND_LOAD_EVENTS)
    return m, dims, _appended(t.spark, "fact_maintenance_events", {
        "load-1": build(m.where(early)), "load-2": build(m.where(~early))})


def gold_fact_maintenance(spark, sf_dir):
    """Maintenance appended in two loads. The cost shares are drawn from a hash of the id, so their
    bounds and their sum are shown rather than their values."""
    f = _keys_once(_maintenance_star(Tables(spark, sf_dir))[2], "maintenance_sk")
    most = F.col("maintenance_cost_usd") / starschema.COST_SHARE_BASE
    share_ok = lambda c: F.col(c).between(F.least(most, F.lit(0.0)), F.greatest(most, F.lit(0.0)))
    return f.select("run_id", "key_uses", "equipment_sk", "technician_sk", "facility_sk", "timestamp_sk",
                    "downtime_minutes", "maintenance_cost_usd", "maintenance_type", "failure_code",
                    (share_ok("parts_cost_usd") & share_ok("labor_cost_usd")).alias("shares_in_range"),
                    (F.col("total_cost_usd") == F.col("parts_cost_usd") + F.col("labor_cost_usd")).alias("shares_add_up"))


def gold_key_runs(spark, sf_dir):
    """Keys of three loads, the second of which is tried twice: rows and distinct keys of each, and
    whether they lie above those of the load before."""
    t = Tables(spark, sf_dir)
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    path = scratch_path(spark, "lines")
    blocks = allocator.KeyBlocks(spark, scratch_path(spark, "lines-keys"))
    day = lambda s: F.lit(s).cast("timestamp_ntz")
    first, last = (F.col("l_shipdate") < day(x) for x in LINE_LOADS)
    loads = [("load-1", first), ("load-2", ~first & last), ("load-2", ~first & last), ("load-3", ~last)]
    for run_id, which in loads:
        allocator.append_with_keys(rows.where(which), path, "line_sk", blocks, run_id)
    per = spark.read.parquet(path).groupBy(F.col(RUN_COL).alias("run_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("line_sk").alias("n_keys"),
        F.min("line_sk").alias("lo"), F.max("line_sk").alias("hi"))
    before = F.lag("hi").over(Window.orderBy("run_id"))             # a row per load
    return per.withColumn("above_before", F.coalesce(F.col("lo") > before, F.lit(True))).select(
        "run_id", "n_rows", "n_keys", "above_before")


def gold_validate(spark, sf_dir):
    """The validation suite over the maintenance star: every foreign key is found (the unknown
    member is a row of its dimension) and unknown members are counted."""
    m, dims, f = _maintenance_star(Tables(spark, sf_dir))
    dims["dim_timestamp"] = starschema.dim_timestamp(m, "start_datetime", CTX)
    found = starschema.validate_gold({"fact_maintenance_events": f}, dims, CTX)
    return found.select("check", "target", "status", "n_bad")


def gold_validate_broken(spark, sf_dir):
    """The suite over a star with faults of every kind: readings without facility or with an unknown
    one, a dimension that lost equipment, and a calendar that ends before the last readings."""
    t = Tables(spark, sf_dir)
    e = F.col("event_id")
    f = t.events.select(
        e.alias("sensor_reading_sk"), F.col("user_id").alias("equipment_sk"),
        F.when(e % NULL_FACILITY_EVERY == 0, F.lit(None)).when(e % NULL_TECHNICIAN_EVERY == 0, model.UNKNOWN_SK)
        .otherwise(F.length("event_type")).cast("bigint").alias("facility_sk"),
        date_key("ts").alias("timestamp_sk"), F.col("value").alias("temperature"), F.lit("r").alias(RUN_COL))
    ids = t.events.select("user_id").distinct()
    equipment_dim = ids.where(F.col("user_id") % LOST_EQUIPMENT != 0).select(
        F.col("user_id").alias("equipment_sk"), F.col("user_id").cast("string").alias("equipment_id"))
    facility_dim = t.events.select(F.length("event_type").cast("bigint").alias("facility_sk"),
                                   F.lit(None).cast("string").alias("facility_id")).distinct() \
        .unionByName(spark.range(1).select(F.lit(model.UNKNOWN_SK).cast("bigint").alias("facility_sk"), F.lit("x").alias("facility_id")))
    early = t.events.where(_before("ts", SECOND_LOAD_EVENTS))
    dims = {"dim_equipment": equipment_dim, "dim_facility": facility_dim, "dim_timestamp": starschema.dim_timestamp(early, "ts", CTX)}
    return starschema.validate_gold({"fact_sensor_readings": f}, dims, CTX).select("check", "target", "severity", "status", "n_bad")


def _cleansed(entity: str, bronze: DataFrame, order: list[str]) -> DataFrame:
    _, v = rulesets.cleanse(entity, bronze, CTX, order)
    return v.groupBy("violated_rule_id", "action_taken").agg(F.count(F.lit(1)).alias("n"))


def _nulled(column, key: str, every: int):
    return F.when(F.col(key) % every != 0, F.col(column) if isinstance(column, str) else column)


def cleanse_telemetry(spark, sf_dir):
    """Hourly readings: several in an hour are duplicates."""
    tel = telemetry(Tables(spark, sf_dir))
    return _cleansed("iot_telemetry", tel.withColumns({
        "device_id": _nulled("device_id", "event_id", NULL_DEVICE_EVERY),
        "facility_id": _nulled("facility_id", "event_id", NULL_FACILITY_EVERY),
        "event_timestamp": F.date_trunc("hour", "event_timestamp")}), ["event_timestamp", "event_id"])


def cleanse_orders(spark, sf_dir):
    """Orders by customer: later ones of the same customer are duplicates."""
    o = Tables(spark, sf_dir).orders
    bronze = o.select("o_orderkey", "o_orderdate", F.col("o_custkey").cast("string").alias("order_id"),
                      _nulled("o_orderpriority", "o_orderkey", NULL_FACILITY_EVERY).alias("facility_id"),
                      _nulled("o_orderstatus", "o_orderkey", NULL_DEVICE_EVERY).alias("equipment_id"))
    return _cleansed("production_orders", bronze, ["o_orderdate", "o_orderkey"])


def cleanse_maintenance(spark, sf_dir):
    """Changes per device: superseded ones are information, not defects."""
    e = Tables(spark, sf_dir).events
    bronze = e.select("event_id", "ts", _nulled(F.col("user_id").cast("string"), "event_id", NULL_DEVICE_EVERY)
                      .alias("maintenance_id"))
    return _cleansed("maintenance_records", bronze, ["ts", "event_id"])


def cleanse_inspections(spark, sf_dir):
    """Lines as inspections: passed may fall below zero, passed and rejected may exceed inspected."""
    li = Tables(spark, sf_dir).lineitem
    q, pct = F.col("l_quantity").cast("int"), lambda c: F.round(F.col(c) * 100).cast("int")
    bronze = li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("inspection_id"),
        _nulled(F.col("l_orderkey").cast("string"), "l_partkey", NULL_DEVICE_EVERY).alias("order_id"),
        q.alias("units_inspected"), (q - pct("l_discount")).alias("units_passed"), pct("l_tax").alias("units_rejected"),
        F.col("l_shipdate").alias("inspection_timestamp"), "l_partkey", "l_suppkey", "l_extendedprice")
    return _cleansed("quality_inspection", bronze, ["inspection_timestamp", "l_partkey", "l_suppkey", "l_extendedprice"])
