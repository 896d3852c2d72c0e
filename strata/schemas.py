"""Declared table shapes (typed table definitions): the records the library emits and the
star schema. Used with `sources.writers.conform` and the NOT NULL check; Spark's file
tables do not enforce NOT NULL on insert, so required keys are listed separately."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
          "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(),
          "timestamp": T.TimestampType()}


def _s(spec: str) -> T.StructType:
    """`"name type, ..."` with simple types -> StructType (no session needed at import)."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in
                         (f.split() for f in spec.split(","))])


VIOLATION = _s("violation_id string, source_table string, record_key string, violated_rule_id string, "
               "violated_rule_desc string, field_name string, field_value string, action_taken string, "
               "detected_at timestamp, pipeline_run_id string, payload string")
AUDIT = _s("event_timestamp timestamp, user_identity string, action_type string, target_table string, "
           "target_database string, query_text string, pipeline_run_id string, n_rows bigint")
CHECK_RESULT = _s("check string, target string, severity string, status string, n_bad bigint, "
                  "pipeline_run_id string")

DIM_FACILITY = _s("facility_sk bigint, facility_id string, facility_name string, region string, "
                  "country string, city string, timezone string, facility_status string, "
                  "is_active boolean, created_at timestamp, updated_at timestamp")
DIM_TIMESTAMP = _s("date_day date, timestamp_sk int, year int, quarter int, month int, month_name string, "
                   "month_short_name string, week_of_year int, day_of_month int, day_of_week_number int, "
                   "day_name string, is_weekend boolean, is_month_end boolean, is_year_end boolean, "
                   "fiscal_quarter string, created_at timestamp")
DIM_TECHNICIAN = _s("technician_sk bigint, technician_id string, technician_name string, "
                    "certification_level string, region string, is_active boolean, created_at timestamp")
DIM_PRODUCTION_ORDER = _s("order_sk bigint, order_id string, product_type string, priority string, "
                          "planned_start_date date, planned_end_date date, facility_id string, "
                          "created_at timestamp")
DIM_EQUIPMENT = _s("equipment_sk bigint, equipment_id string, facility_id string, equipment_type string, "
                   "manufacturer string, model_number string, equipment_status string, "
                   "criticality_level string, asset_value_usd double, effective_start_date date, "
                   "effective_end_date date, is_current boolean, version_number int")
FACT_SENSOR_READINGS = _s("sensor_reading_sk bigint, equipment_sk bigint, facility_sk bigint, "
                          "timestamp_sk int, temperature double, vibration_x double, vibration_y double, "
                          "device_id string, equipment_type string, pressure double, "
                          "power_consumption double, rpm int, anomaly_score double, is_anomaly boolean, "
                          "_pipeline_run_id string, created_at timestamp")
FACT_PRODUCTION_OUTPUT = _s("production_sk bigint, order_sk bigint, equipment_sk bigint, facility_sk bigint, "
                            "timestamp_sk int, units_produced int, units_passed int, units_rejected int, "
                            "defect_count int, defect_rate double, yield_rate double, "
                            "_pipeline_run_id string, created_at timestamp")
FACT_MAINTENANCE_EVENTS = _s("maintenance_sk bigint, equipment_sk bigint, technician_sk bigint, "
                             "facility_sk bigint, timestamp_sk int, downtime_minutes int, "
                             "maintenance_cost_usd double, parts_cost_usd double, labor_cost_usd double, "
                             "total_cost_usd double, maintenance_type string, failure_code string, "
                             "_pipeline_run_id string, created_at timestamp")

# Keys that must never be NULL: counted by `checks.null_counts`, enforced by `writers.enforce_required`.
REQUIRED = {
    "dim_facility": ["facility_sk", "facility_id"], "dim_timestamp": ["date_day", "timestamp_sk"],
    "dim_technician": ["technician_sk", "technician_id"], "dim_production_order": ["order_sk", "order_id"],
    "dim_equipment": ["equipment_sk", "equipment_id"],
    "fact_sensor_readings": ["sensor_reading_sk", "equipment_sk", "facility_sk", "timestamp_sk"],
    "fact_production_output": ["production_sk", "order_sk", "equipment_sk", "facility_sk", "timestamp_sk"],
    "fact_maintenance_events": ["maintenance_sk", "equipment_sk", "technician_sk", "facility_sk", "timestamp_sk"],
}
