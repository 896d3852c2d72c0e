"""Gold-layer builders for the manufacturing star schema (FIXTURES.md §3), composed from
the library: surrogate keys from key maps, a date dimension spanning the facts' own
dates, temporal joins to versioned equipment, unknown members instead of silently
dropped rows, repeatable cost shares and guarded measures. Every output is conformed to
its declared shape in `strata.schemas`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas
from .context import RunContext
from .functions.dates import date_key
from .functions.hashing import hash_bucket
from .operators import allocator, asof, checks, dedup, history, keys, model, report
from .sources.writers import RUN_COL, conform, enforce_required

# Default attributes of derived dimension members.
FACILITY_NAME_PREFIX = "Facility "
FACILITY_REGION, FACILITY_COUNTRY = "NA", "USA"
FACILITY_CITY_PREFIX = "City_"
FACILITY_TIMEZONE, FACILITY_STATUS = "UTC", "ACTIVE"
TECHNICIAN_NAME_PREFIX, TECHNICIAN_LEVEL, TECHNICIAN_REGION = "Tech_", "LEVEL_1", "NA"
# Repeatable cost split: each share is a row-derived fraction of cost / 10.
COST_SHARE_BASE = 10.0
SHARE_BUCKETS = 1000


UNKNOWN_MEMBER = "UNKNOWN"


def with_unknown(dim: DataFrame, sk_col: str, natural_key: str) -> DataFrame:
    """The dimension with its unknown member, the row that facts without a match point to."""
    values = {sk_col: model.UNKNOWN_SK, natural_key: UNKNOWN_MEMBER}
    row = [tuple(values.get(f.name) for f in dim.schema.fields)]
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in dim.schema.fields])
    return dim.unionByName(dim.sparkSession.createDataFrame(row, nullable))


def _stamp(ctx: RunContext) -> Column:
    return F.lit(ctx.as_of).cast("timestamp")


def dim_facility(telemetry: DataFrame, ctx: RunContext, key_map: DataFrame | None = None) -> DataFrame:
    fid = F.col("facility_id")
    attrs = {
        "facility_name": F.concat(F.lit(FACILITY_NAME_PREFIX), fid),
        "region": F.lit(FACILITY_REGION), "country": F.lit(FACILITY_COUNTRY),
        "city": F.concat(F.lit(FACILITY_CITY_PREFIX), fid), "timezone": F.lit(FACILITY_TIMEZONE),
        "facility_status": F.lit(FACILITY_STATUS), "is_active": F.lit(True),
        "created_at": _stamp(ctx), "updated_at": _stamp(ctx),
    }
    d = model.dimension_from_fact(telemetry, "facility_id", attrs, "facility_sk", key_map)
    return with_unknown(conform(d, schemas.DIM_FACILITY), "facility_sk", "facility_id")


def dim_technician(maintenance: DataFrame, ctx: RunContext, key_map: DataFrame | None = None) -> DataFrame:
    src = maintenance.select(F.col("maintenance_technician_id").alias("technician_id"))
    attrs = {
        "technician_name": F.concat(F.lit(TECHNICIAN_NAME_PREFIX), F.col("technician_id")),
        "certification_level": F.lit(TECHNICIAN_LEVEL), "region": F.lit(TECHNICIAN_REGION),
        "is_active": F.lit(True), "created_at": _stamp(ctx),
    }
    d = model.dimension_from_fact(src, "technician_id", attrs, "technician_sk", key_map)
    return with_unknown(conform(d, schemas.DIM_TECHNICIAN), "technician_sk", "technician_id")


def dim_production_order(orders: DataFrame, ctx: RunContext, key_map: DataFrame | None = None) -> DataFrame:
    """One row per order: of several the one planned last."""
    rows = orders.select(
        "order_id", F.col("product_sku").alias("product_type"), "priority",
        F.to_date("start_time").alias("planned_start_date"),
        F.lit(None).cast("date").alias("planned_end_date"), "facility_id")
    rows = dedup.winners(rows, ["order_id"], ["planned_start_date"]).withColumn("created_at", _stamp(ctx))
    d = conform(keys.assign_keys(rows, ["order_id"], "order_sk", key_map), schemas.DIM_PRODUCTION_ORDER)
    return with_unknown(d, "order_sk", "order_id")


def dim_equipment(equipment_history: DataFrame, key_map: DataFrame | None = None) -> DataFrame:
    """Every version of every equipment, one surrogate key per (equipment_id, version)."""
    rows = equipment_history.select(
        "equipment_id", "facility_id", "equipment_type", "manufacturer", "model_number",
        "equipment_status", "criticality_level", "asset_value_usd", history.START, history.END,
        history.CURRENT, history.VERSION)
    d = keys.assign_keys(rows, ["equipment_id", history.VERSION], "equipment_sk", key_map)
    return with_unknown(conform(d, schemas.DIM_EQUIPMENT), "equipment_sk", "equipment_id")


def dim_timestamp(fact_dates: DataFrame, date_col: str, ctx: RunContext) -> DataFrame:
    """Daily spine over the facts' own date range (grows with the data)."""
    bounds = fact_dates.agg(F.min(F.to_date(date_col)).alias("lo"), F.max(F.to_date(date_col)).alias("hi"))
    d = model.date_dimension(model.date_spine(bounds, "lo", "hi"))
    renamed = d.select(
        "date_day", "timestamp_sk", F.col("y").alias("year"), F.col("q").alias("quarter"),
        F.col("m").alias("month"), "month_name", F.col("mon").alias("month_short_name"),
        F.col("w").alias("week_of_year"), F.col("dom").alias("day_of_month"),
        F.col("dow").alias("day_of_week_number"), "day_name", "is_weekend", "is_month_end",
        "is_year_end", F.col("fq").alias("fiscal_quarter"), _stamp(ctx).alias("created_at"))
    return conform(renamed, schemas.DIM_TIMESTAMP)


def _equipment_sk(facts: DataFrame, equipment: DataFrame, fact_key: str | None, fact_date: str) -> DataFrame:
    """Temporal lookup of the equipment version valid on the fact's date; -1 if none."""
    if fact_key is None:
        return facts.withColumn("equipment_sk", F.lit(model.UNKNOWN_SK).cast("bigint"))
    v = equipment.select(F.col("equipment_id").alias("__eq"), F.col(history.START).alias("__st"),
                         F.col(history.END).alias("__en"), F.col("equipment_sk").alias("__esk"))
    j = asof.asof_join(facts, v, fact_key, "__eq", fact_date, "__st", "__en")
    return (j.withColumn("equipment_sk", F.coalesce(F.col("__esk"), F.lit(model.UNKNOWN_SK).cast("bigint")))
            .drop("__eq", "__st", "__en", "__esk"))


def _numbered(f: DataFrame, order: list[str], sk_col: str, first_sk: int | None) -> DataFrame:
    """Dense keys from `first_sk`, or none yet: `append_fact` gives them in the write."""
    if first_sk is None:
        return f.withColumn(sk_col, F.lit(None).cast("bigint"))
    return keys.dense_keys(f, order, sk_col, start=first_sk)


# The surrogate key of each fact.
FACT_KEYS = {"fact_sensor_readings": "sensor_reading_sk", "fact_production_output": "production_sk",
             "fact_maintenance_events": "maintenance_sk"}


def append_fact(fact: DataFrame, name: str, path: str, high_water: str, ctx: RunContext,
                strict: bool = False) -> dict:
    """Append a fact built with `first_sk=None` as this run's rows under `path`. Its keys come from
    blocks above the high water stored in the folder `high_water`, in the job that writes: no
    sort, no checkpoint and no second plan of the fact, and no key is given twice over all runs. With `strict` a NULL in
    one of the fact's required columns fails the write."""
    if strict:
        fact = enforce_required(fact, [c for c in schemas.REQUIRED[name] if c != FACT_KEYS[name]], name)
    blocks = allocator.KeyBlocks(fact.sparkSession, high_water)
    return allocator.append_with_keys(fact.drop(RUN_COL), path, FACT_KEYS[name], blocks, ctx.run_id)


def fact_sensor_readings(telemetry: DataFrame, equipment: DataFrame, facility: DataFrame,
                         ctx: RunContext, equipment_key: str | None = None, first_sk: int | None = 1) -> DataFrame:
    """One row per valid reading, numbered from `first_sk` by device and time (None: `append_fact`
    gives the keys). Readings carry no equipment id in the landed data, so
    `equipment_key=None` records the unknown member instead of multiplying each reading
    by every equipment of its facility."""
    f = telemetry.withColumn("__d", F.to_date("event_timestamp"))
    f = _equipment_sk(f, equipment, equipment_key, "__d")
    f = model.lookup_keys(f, facility, "facility_id", "facility_id", "facility_sk")
    f = _numbered(f, ["device_id", "event_timestamp"], "sensor_reading_sk", first_sk)
    out = f.select(
        "sensor_reading_sk", "equipment_sk", "facility_sk", date_key("__d").alias("timestamp_sk"), "temperature",
        "vibration_x", "vibration_y", "device_id", "equipment_type", "pressure", "power_consumption",
        F.col("rpm").cast("int").alias("rpm"), F.lit(ctx.run_id).alias("_pipeline_run_id"),
        _stamp(ctx).alias("created_at"))
    return conform(out, schemas.FACT_SENSOR_READINGS)


def fact_production_output(orders: DataFrame, inspections: DataFrame, order_dim: DataFrame,
                           equipment: DataFrame, facility: DataFrame, ctx: RunContext,
                           first_sk: int | None = 1) -> DataFrame:
    """Grain: one inspection of an order (inner: an order needs an inspection to have output),
    numbered from `first_sk` by order and inspection (None: `append_fact` gives the keys)."""
    q = inspections.select("inspection_id", "order_id", "units_rejected", "units_inspected", "units_passed")
    f = orders.select("order_id", "equipment_id", "facility_id", "quantity_ordered", "start_time") \
        .join(q, "order_id").withColumn("__d", F.to_date("start_time"))
    f = model.lookup_keys(f, order_dim, "order_id", "order_id", "order_sk")
    f = _equipment_sk(f, equipment, "equipment_id", "__d")
    f = model.lookup_keys(f, facility, "facility_id", "facility_id", "facility_sk")
    f = _numbered(f, ["order_id", "inspection_id"], "production_sk", first_sk)
    m = model.production_measures(F.col("quantity_ordered"), F.col("units_rejected"),
                                  F.col("units_inspected"), F.col("units_passed"))
    out = f.select(
        "production_sk", "order_sk", "equipment_sk", "facility_sk", date_key("__d").alias("timestamp_sk"),
        F.col("quantity_ordered").alias("units_produced"), m["units_passed"].alias("units_passed"),
        F.col("units_rejected"), m["defect_count"].alias("defect_count"),
        m["defect_rate"].alias("defect_rate"), m["yield_on_ordered"].alias("yield_rate"),
        F.lit(ctx.run_id).alias("_pipeline_run_id"), _stamp(ctx).alias("created_at"))
    return conform(out, schemas.FACT_PRODUCTION_OUTPUT)


def fact_maintenance_events(maintenance: DataFrame, equipment: DataFrame, technician: DataFrame,
                            facility: DataFrame, ctx: RunContext, first_sk: int | None = 1) -> DataFrame:
    """Live (not soft-deleted) maintenance rows, numbered from `first_sk` by id (None: `append_fact`
    gives the keys); cost shares are repeatable per row."""
    live = maintenance.filter(~F.coalesce(F.col("is_deleted"), F.lit(False)))
    f = live.withColumn("__d", F.to_date("start_datetime"))
    f = _equipment_sk(f, equipment, "equipment_id", "__d")
    f = model.lookup_keys(f, technician, "maintenance_technician_id", "technician_id", "technician_sk")
    f = model.lookup_keys(f, facility, "facility_id", "facility_id", "facility_sk")
    f = _numbered(f, ["maintenance_id"], "maintenance_sk", first_sk)
    base = F.col("maintenance_cost_usd") / F.lit(COST_SHARE_BASE)
    parts = base * hash_bucket(SHARE_BUCKETS, "maintenance_id", salt="parts") / F.lit(float(SHARE_BUCKETS))
    labor = base * hash_bucket(SHARE_BUCKETS, "maintenance_id", salt="labor") / F.lit(float(SHARE_BUCKETS))
    out = f.select(
        "maintenance_sk", "equipment_sk", "technician_sk", "facility_sk", date_key("__d").alias("timestamp_sk"),
        "downtime_minutes", "maintenance_cost_usd", parts.alias("parts_cost_usd"),
        labor.alias("labor_cost_usd"), (parts + labor).alias("total_cost_usd"), "maintenance_type",
        "failure_code", F.lit(ctx.run_id).alias("_pipeline_run_id"), _stamp(ctx).alias("created_at"))
    return conform(out, schemas.FACT_MAINTENANCE_EVENTS)


# Metadata columns every fact carries, and check severities.
FACT_METADATA = ("_pipeline_run_id", "created_at")
ERROR, WARN = "ERROR", "WARN"


#: The dimension each foreign key of a fact points to.
DIMENSION_KEYS = {"dim_facility": "facility_sk", "dim_equipment": "equipment_sk", "dim_technician": "technician_sk",
                  "dim_production_order": "order_sk", "dim_timestamp": "timestamp_sk"}


def _key_profile(name: str, df: DataFrame, foreign: list[str], required: list[str]) -> DataFrame:
    """(target, col, key, n): how often each value of a foreign key occurs, and how often a required
    column is NULL. One scan, counted before anything moves, so a key (or the unknown member) that
    holds a third of the rows leaves a task as one row."""
    entry = lambda c, key: F.struct(F.lit(c).alias("col"), key.cast("bigint").alias("key"))
    wanted = [entry(c, F.col(c)) for c in foreign]
    wanted += [F.when(F.col(c).isNull(), entry(c, F.lit(None))) for c in required if c not in foreign]
    return (df.select(F.explode(F.array_compact(F.array(*wanted))).alias("e")).groupBy("e.col", "e.key")
            .agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("target"), "col", "key", "n"))


def validate_gold(facts: dict[str, DataFrame], dims: dict[str, DataFrame], ctx: RunContext,
                  analyst_view: DataFrame | None = None, masked: tuple[DataFrame, str] | None = None,
                  sources: dict[str, tuple[DataFrame, DataFrame, list[str]]] | None = None) -> DataFrame:
    """The validation suite over a built star schema, as one result frame:
    source→bronze reconciliation (WARN), required and metadata columns, NOT NULL keys,
    fact→dimension FK integrity, facts on the unknown member (WARN), date coverage,
    single-scope analyst view (WARN) and whole-column masking.

    `facts` / `dims` are keyed by table name as in `schemas.REQUIRED`; `sources` maps a
    name to (source, bronze, key columns). Every table is read once: what all key checks need are
    the counts of its key values, which meet all dimensions' keys in a single join."""
    rows: list[DataFrame] = []
    for name, (src, bronze, key) in (sources or {}).items():
        r = checks.reconcile(src, bronze, key).select((F.col("n_missing") + F.col("n_extra")).alias("n"))
        rows.append(checks.check_row("reconcile", name, WARN, r, ctx))
    declared = {"fact_sensor_readings": schemas.FACT_SENSOR_READINGS,
                "fact_production_output": schemas.FACT_PRODUCTION_OUTPUT,
                "fact_maintenance_events": schemas.FACT_MAINTENANCE_EVENTS}
    expected: list[tuple[str, str, str, str, str, int]] = []    # check, target, severity, col, kind, known count
    profiles: list[DataFrame] = []
    spark = None
    for name, df in {**facts, **dims}.items():
        spark = df.sparkSession
        foreign = [sk for d, sk in DIMENSION_KEYS.items() if d in dims and sk in df.columns] if name in facts else []
        required = [c for c in schemas.REQUIRED.get(name, []) if c in df.columns]
        if foreign or required:
            profiles.append(_key_profile(name, df, foreign, required))
        if name in facts:
            gaps = checks.schema_gaps(df, [f.name for f in declared[name].fields])["missing"] if name in declared else []
            gaps = {*gaps, *(c for c in FACT_METADATA if c not in df.columns)}
            expected.append(("columns", name, ERROR, "", "", len(gaps)))
        expected += [("not_null", name, ERROR, c, "nulls", 0) for c in required]
        for sk in foreign:
            expected.append((f"fk_{sk}", name, ERROR, sk, "orphans", 0))
            if sk != "timestamp_sk":
                expected.append((f"unknown_{sk}", name, WARN, sk, "unknown", 0))
        if "dim_timestamp" in dims and "timestamp_sk" in foreign:
            expected.append(("date_coverage", name, ERROR, "timestamp_sk", "undated", 0))
    if profiles:
        rows.append(_judged(spark, profiles, dims, expected, ctx))
    if analyst_view is not None:
        scope = checks.distinct_count(analyst_view, "facility_sk").select((F.col("n") - 1).alias("n"))
        rows.append(checks.check_row("single_scope", "analyst_view", WARN, scope, ctx))
    if masked is not None:
        view, col = masked
        rows.append(checks.check_row("masking", col, ERROR, checks.unmasked_count(view, col, null_ok=True), ctx))
    return report.union_all(rows)


def _judged(spark, profiles: list[DataFrame], dims: dict[str, DataFrame], expected: list[tuple], ctx: RunContext) -> DataFrame:
    """One result row for each (check, target) of `expected` from the key counts of all tables."""
    known = [dims[d].select(F.lit(sk).alias("col"), F.col(sk).cast("bigint").alias("key"),
                            (F.col("date_day") if d == "dim_timestamp" else F.lit(None).cast("date")).alias("day"))
             for d, sk in DIMENSION_KEYS.items() if d in dims and sk in dims[d].columns]
    n, counts = F.col("n"), report.union_all(profiles)
    if known:
        keys_of = report.union_all(known).groupBy("col", "key").agg(F.lit(True).alias("found"), F.max("day").alias("day"))
        counts = counts.join(keys_of, ["col", "key"], "left")
    else:
        counts = counts.withColumns({"found": F.lit(None).cast("boolean"), "day": F.lit(None).cast("date")})
    day = F.try_to_date(F.col("key").cast("string"), "yyyyMMdd")
    kinds = {"nulls": F.col("key").isNull(), "orphans": F.col("found").isNull(), "unknown": F.col("key") == model.UNKNOWN_SK,
             "undated": F.col("day").isNull() | ~F.col("day").eqNullSafe(day)}
    found = (counts.groupBy("target", "col").agg(*[F.sum(F.when(c, n)).alias(k) for k, c in kinds.items()])
             .unpivot(["target", "col"], list(kinds), "kind", "bad"))
    wanted = spark.createDataFrame(expected, "check string, target string, severity string, col string, kind string, at_least bigint")
    totals = (wanted.join(found, ["target", "col", "kind"], "left").groupBy("check", "target", "severity")
              .agg(F.sum(F.col("at_least") + F.coalesce("bad", F.lit(0))).alias("n")))
    return totals.select("check", "target", "severity",
                         F.when(F.col("n") > 0, F.lit("FAIL")).otherwise(F.lit("PASS")).alias("status"),
                         F.col("n").cast("bigint").alias("n_bad"), F.lit(ctx.run_id).alias("pipeline_run_id"))
