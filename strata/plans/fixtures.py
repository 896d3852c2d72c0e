"""Stand-ins that map the driver tables onto the toolkit's entities.

The driver tables hold no NULLs and no bad rows, so a proof that wants to see the
quarantine branch injects defects by a fixed expression of the row id. These modulo
expressions decide *which rows are defective*, not which rows are read: every proof
still scans its whole table. The same expressions appear in the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import case_map

# Defect-injection moduli and the stand-in cut-over instants.
NULL_DEVICE_EVERY = 101
NULL_FACILITY_EVERY = 103
NULL_TECHNICIAN_EVERY = 11
CDC_SPLIT = "2024-01-01 06:00:00"     # changes before it form the base, all others the increment
LATE_STATE_TYPES = ("view", "click")  # changes from these sources were stored first
PART_V2_FROM = "1998-01-01"
PART_V1_FROM = "1995-01-01"


def telemetry(events: DataFrame) -> DataFrame:
    """events as raw telemetry: user_id = device, event_type = facility, NULLs injected."""
    e = F.col("event_id")
    return events.select(
        "event_id", "ts", "value",
        F.when(e % NULL_DEVICE_EVERY != 0, F.col("user_id")).alias("device_id"),
        F.when(e % NULL_FACILITY_EVERY != 0, F.col("event_type")).alias("facility_id"),
    )


def change_log(events: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """All events as a change log: key = user_id, lsn = event_id, op from event_type.
    `carry` passes extra event columns through (e.g. a batch label)."""
    op = case_map("event_type", {"signup": "INSERT", "error": "DELETE"}, "UPDATE")
    return events.select(F.col("user_id").alias("k"), F.col("event_id").alias("lsn"), "ts", "value",
                         op.alias("op"), *carry)


def part_versions(part: DataFrame) -> DataFrame:
    """part as a versioned dimension: every third part changed on 1998-01-01."""
    changed = F.col("p_partkey") % 3 == 0
    v1 = part.select("p_partkey", F.lit(1).alias("ver"), F.lit(PART_V1_FROM).cast("date").alias("st"),
                     F.when(changed, F.lit(PART_V2_FROM).cast("date")).alias("en"))
    v2 = part.filter(changed).select("p_partkey", F.lit(2).alias("ver"),
                                     F.lit(PART_V2_FROM).cast("date").alias("st"),
                                     F.lit(None).cast("date").alias("en"))
    return v1.unionByName(v2)
