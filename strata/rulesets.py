"""Ready-made rule sets for the four landed manufacturing entities (telemetry, production
orders, maintenance change log, quality inspections), expressed with the generic rule
constructors, plus each entity's business key and duplicate rule id. A switching user
gets the same rule ids and reasons; the order of the list is the order in which the
first failing reason is chosen.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions.expressions import guarded_ratio
from .operators.rules import INFO, QUARANTINE, Rule, in_range, non_negative, required

# Rule ids, descriptions, bounds, keys and duplicate ids per entity.
TEMPERATURE_RANGE = (-50, 150)
VIBRATION_RANGE = (0, 100)
ENTITY_KEYS = {
    "iot_telemetry": ["device_id", "event_timestamp"],
    "production_orders": ["order_id"],
    "maintenance_records": ["maintenance_id"],
    "quality_inspection": ["inspection_id"],
}
DUPLICATE_RULE = {
    "iot_telemetry": ("DQ-006", "Duplicate telemetry event"),
    "production_orders": ("DQ-PO-004", "Duplicate order"),
    "maintenance_records": ("DQ-MR-002", "Superseded change"),
    "quality_inspection": ("DQ-QI-006", "Duplicate inspection"),
}
# a superseded change is history, not a defect
DUPLICATE_ACTION = {"maintenance_records": INFO}
ORPHAN_ORDER_RULE = ("DQ-010", "order_id does not exist in production_orders")


def telemetry_rules() -> list[Rule]:
    return [
        required("device_id", "DQ-001", description="device_id NULL"),
        required("event_timestamp", "DQ-002", description="event_timestamp NULL"),
        required("facility_id", "DQ-003", description="facility_id NULL"),
        in_range("temperature", *TEMPERATURE_RANGE, "DQ-004", description="temperature invalid"),
        in_range("vibration_x", *VIBRATION_RANGE, "DQ-005", description="vibration_x invalid"),
    ]


def production_order_rules() -> list[Rule]:
    return [
        required("order_id", "DQ-PO-001", description="order_id NULL"),
        required("facility_id", "DQ-PO-002", description="facility_id NULL"),
        required("equipment_id", "DQ-PO-003", description="equipment_id NULL"),
    ]


def maintenance_rules() -> list[Rule]:
    return [required("maintenance_id", "DQ-MR-001", description="maintenance_id NULL")]


def inspection_rules() -> list[Rule]:
    units = ["units_inspected", "units_passed", "units_rejected"]
    consistent = (F.col("units_passed") + F.col("units_rejected") <= F.col("units_inspected"))
    present = F.col("units_passed").isNotNull() & F.col("units_rejected").isNotNull() \
        & F.col("units_inspected").isNotNull()
    return [
        required("inspection_id", "DQ-QI-001", description="inspection_id NULL"),
        required("order_id", "DQ-QI-002", description="order_id NULL"),
        non_negative(units, "DQ-QI-003", description="invalid unit values"),
        Rule("DQ-QI-004", present & consistent, description="units inconsistent"),
        required("inspection_timestamp", "DQ-QI-005", description="inspection_timestamp NULL"),
    ]


RULES = {
    "iot_telemetry": telemetry_rules,
    "production_orders": production_order_rules,
    "maintenance_records": maintenance_rules,
    "quality_inspection": inspection_rules,
}


def descriptions(entity: str) -> dict[str, str]:
    """rule id -> description for violation records (includes the duplicate rule)."""
    d = {r.rule_id: r.description for r in RULES[entity]()}
    dup_id, dup_desc = DUPLICATE_RULE[entity]
    return d | {dup_id: dup_desc}


def inspection_derived() -> dict:
    """Cleanse-time derived columns of inspections (guarded rates, event date)."""
    return {
        "inspection_date": F.to_date("inspection_timestamp"),
        "yield_rate": guarded_ratio(F.col("units_passed"), F.col("units_inspected")),
        "defect_rate": guarded_ratio(F.col("units_rejected"), F.col("units_inspected")),
    }


def telemetry_derived() -> dict:
    return {"event_date": F.to_date("event_timestamp")}


DERIVED = {"iot_telemetry": telemetry_derived, "quality_inspection": inspection_derived}


def cleanse(entity: str, bronze, ctx, order, locator: str | None = None):
    """Silver step for one entity: derived columns, rules, latest-per-key dedup (total
    `order`, largest wins), run stamp — one classified frame — and its violation records
    (failures: QUARANTINE; duplicates: the entity's duplicate rule and action).

    Returns (classified, violations)."""
    from .operators import rules as R
    derived = DERIVED.get(entity)
    df = bronze.withColumns(derived()) if derived else bronze
    classified = R.stamp(R.classify(df, RULES[entity](), ENTITY_KEYS[entity], order), ctx)
    key = ENTITY_KEYS[entity][0]
    dup_id, _ = DUPLICATE_RULE[entity]
    v = R.all_violations(classified, entity, key, dup_id, locator or order[-1],
                         descriptions=descriptions(entity), ctx=ctx,
                         duplicate_action=DUPLICATE_ACTION.get(entity, QUARANTINE))
    return classified, v
