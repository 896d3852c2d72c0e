"""Gold builders on small hand-written silver tables shaped like the landed entities."""
import datetime as dt

from pyspark.sql import functions as F

from strata import schemas, starschema as S
from strata.context import RunContext
from strata.operators import checks, history

def shape(s):
    return [(f.name, f.dataType) for f in s.fields]


CTX = RunContext(run_id="gold-1", as_of=dt.datetime(2026, 3, 1))
D1, D2 = dt.date(2026, 1, 1), dt.date(2026, 2, 1)
T = lambda d, h=8: dt.datetime(d.year, d.month, d.day, h)


def _silver(spark):
    tel = spark.createDataFrame([
        ("DEV-1", T(D1), "FAC-A", "PUMP", 60.0, 1.0, 1.1, 120.0, 10.0, 1500),
        ("DEV-2", T(D2), "FAC-B", "FAN", 70.0, 2.0, 2.1, 130.0, 11.0, 1600),
    ], "device_id string, event_timestamp timestamp, facility_id string, equipment_type string, "
       "temperature double, vibration_x double, vibration_y double, pressure double, "
       "power_consumption double, rpm bigint")
    master = "equipment_id string, facility_id string, equipment_type string, manufacturer string, " \
             "model_number string, equipment_status string, criticality_level string, asset_value_usd double"
    v1 = spark.createDataFrame([("EQ-1", "FAC-A", "PUMP", "M", "X1", "ACTIVE", "HIGH", 10.0),
                                ("EQ-2", "FAC-B", "FAN", "N", "Y1", "ACTIVE", "LOW", 5.0)], master)
    v2 = spark.createDataFrame([("EQ-1", "FAC-A", "PUMP", "M", "X1", "UNDER_MAINTENANCE", "HIGH", 10.0),
                                ("EQ-2", "FAC-B", "FAN", "N", "Y1", "ACTIVE", "LOW", 5.0)], master)
    tracked = ["equipment_status", "manufacturer", "model_number", "criticality_level"]
    eq = history.apply(None, v1, ["equipment_id"], tracked, D1)
    eq = history.apply(eq, v2, ["equipment_id"], tracked, D2)
    orders = spark.createDataFrame([
        ("ORD-1", "FAC-A", "SKU-1", 100, T(D1, 9), "EQ-1", "HIGH"),
        ("ORD-2", "FAC-B", "SKU-2", 0, T(D2, 9), "EQ-404", "LOW"),
    ], "order_id string, facility_id string, product_sku string, quantity_ordered int, "
       "start_time timestamp, equipment_id string, priority string")
    insp = spark.createDataFrame([("INSP-1", "ORD-1", 50, 45, 5), ("INSP-2", "ORD-2", 10, 10, 0),
                                  ("INSP-3", "ORD-9", 10, 9, 1)],
                                 "inspection_id string, order_id string, units_inspected int, "
                                 "units_passed int, units_rejected int")
    maint = spark.createDataFrame([
        ("MNT-1", "EQ-1", "FAC-A", "CORRECTIVE", "TECH-1", T(D1, 12), 30, "FC-1", 1000.0, False),
        ("MNT-2", "EQ-1", "FAC-A", "PREVENTIVE", "TECH-2", T(D2, 12), 40, "FC-2", 500.0, False),
        ("MNT-3", "EQ-2", "FAC-B", "PREDICTIVE", None, T(D2, 12), 50, "FC-3", 200.0, False),
        ("MNT-4", "EQ-2", "FAC-B", "PREDICTIVE", "TECH-1", T(D2, 13), 60, "FC-4", 300.0, True),
    ], "maintenance_id string, equipment_id string, facility_id string, maintenance_type string, "
       "maintenance_technician_id string, start_datetime timestamp, downtime_minutes int, "
       "failure_code string, maintenance_cost_usd double, is_deleted boolean")
    return tel, eq, orders, insp, maint


def test_gold_layer(spark):
    tel, eq, orders, insp, maint = _silver(spark)
    fac = S.dim_facility(tel, CTX)
    tech = S.dim_technician(maint, CTX)
    odim = S.dim_production_order(orders, CTX)
    edim = S.dim_equipment(eq)
    ddim = S.dim_timestamp(tel.select(F.col("event_timestamp").alias("d")), "d", CTX)
    assert shape(fac.schema) == shape(schemas.DIM_FACILITY)
    assert shape(tech.schema) == shape(schemas.DIM_TECHNICIAN)
    assert edim.count() == 4 and edim.select("equipment_sk").distinct().count() == 4      # with the unknown member
    assert tech.count() == 3                                     # NULL technician dropped, unknown member added
    assert ddim.count() == (D2 - D1).days + 1

    sensor = S.fact_sensor_readings(tel, edim, fac, CTX)
    assert sensor.count() == tel.count()                         # no multiplication by facility
    assert sensor.filter("equipment_sk <> -1").count() == 0
    assert checks.missing_dates(sensor.withColumn("d", F.to_date(F.col("timestamp_sk").cast("string"), "yyyyMMdd")),
                                "d", ddim, "date_day").count() == 0

    prod = S.fact_production_output(orders, insp, odim, edim, fac, CTX)
    assert shape(prod.schema) == shape(schemas.FACT_PRODUCTION_OUTPUT) and prod.count() == 2
    by_units = {r.units_produced: r for r in prod.collect()}
    assert by_units[100].yield_rate == 0.95 and by_units[100].units_passed == 95
    assert by_units[0].yield_rate is None and by_units[0].equipment_sk == -1     # unknown member

    mf = S.fact_maintenance_events(maint, edim, tech, fac, CTX)
    assert mf.count() == 3                                       # soft-deleted row excluded
    sk = {r.downtime_minutes: r for r in mf.collect()}
    v = {(r.equipment_id, r.version_number): r.equipment_sk for r in edim.collect()}
    assert sk[30].equipment_sk == v[("EQ-1", 1)] and sk[40].equipment_sk == v[("EQ-1", 2)]
    assert sk[50].technician_sk == -1
    again = {r.downtime_minutes: r.parts_cost_usd for r in S.fact_maintenance_events(maint, edim, tech, fac, CTX).collect()}
    assert all(abs(sk[k].parts_cost_usd - again[k]) < 1e-12 for k in sk)         # repeatable
    assert all(abs(r.total_cost_usd - r.parts_cost_usd - r.labor_cost_usd) < 1e-9 for r in mf.collect())


def test_keys_stable_when_dimension_rebuilt(spark):
    tel, *_ = _silver(spark)
    first = S.dim_facility(tel, CTX)
    more = tel.unionByName(tel.limit(1).withColumn("facility_id", F.lit("FAC-0")))
    second = S.dim_facility(more, CTX, key_map=first.select("facility_id", "facility_sk"))
    a = dict((r.facility_id, r.facility_sk) for r in first.collect())
    b = dict((r.facility_id, r.facility_sk) for r in second.collect())
    assert all(b[k] == v for k, v in a.items()) and b["FAC-0"] == max(a.values()) + 1


def test_validate_gold_suite(spark):
    from strata.operators import checks as K
    from strata.operators import governance as G
    from strata.functions import mask_prefix
    tel, eq, orders, insp, maint = _silver(spark)
    fac, tech = S.dim_facility(tel, CTX), S.dim_technician(maint, CTX)
    odim, edim = S.dim_production_order(orders, CTX), S.dim_equipment(eq)
    ddim = S.dim_timestamp(tel.select(F.col("event_timestamp").alias("d")), "d", CTX)
    sensor = S.fact_sensor_readings(tel, edim, fac, CTX)
    mf = S.fact_maintenance_events(maint, edim, tech, fac, CTX)
    ent = spark.createDataFrame([("ana", "FAC-A")], "principal string, scope_value string")
    view = G.row_scope(sensor.join(fac.select("facility_sk", "facility_id"), "facility_sk"),
                       "facility_id", ent, "ana")
    masked = G.mask_columns(maint, {"maintenance_technician_id": lambda c: mask_prefix(c, 5)})
    res = S.validate_gold(
        facts={"fact_sensor_readings": sensor, "fact_maintenance_events": mf},
        dims={"dim_facility": fac, "dim_technician": tech, "dim_equipment": edim, "dim_timestamp": ddim,
              "dim_production_order": odim},
        ctx=CTX, analyst_view=view, masked=(masked, "maintenance_technician_id"),
        sources={"telemetry": (tel, tel, ["device_id", "event_timestamp"])})
    got = {(r.check, r.target): (r.status, r.n_bad) for r in res.collect()}
    assert got[("reconcile", "telemetry")] == ("PASS", 0)
    assert got[("single_scope", "analyst_view")] == ("PASS", 0)
    assert got[("masking", "maintenance_technician_id")] == ("PASS", 0)
    # readings carry no equipment id: they point to the unknown member, which is counted
    assert got[("fk_equipment_sk", "fact_sensor_readings")] == ("PASS", 0)
    assert got[("unknown_equipment_sk", "fact_sensor_readings")] == ("FAIL", 2)
    assert got[("date_coverage", "fact_sensor_readings")] == ("PASS", 0)
    assert got[("not_null", "dim_facility")] == ("PASS", 0)
    assert res.filter("severity = 'ERROR' and status = 'FAIL'").count() == 0
    K.enforce(res)
    lost = S.validate_gold({"fact_maintenance_events": mf}, {"dim_technician": tech.filter("technician_sk <> -1")}, CTX)
    import pytest
    with pytest.raises(K.CheckFailed):
        K.enforce(lost)
    assert sorted(r.maintenance_sk for r in mf.collect()) == [1, 2, 3]
    assert sorted(r.sensor_reading_sk for r in sensor.collect()) == [1, 2]
