"""Proof registry: query name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import cdc, gold, governed, io, quality, star
from .oracle import ORACLE

Query = Callable[[SparkSession, str], DataFrame]


def _from(module, names) -> dict[str, Query]:
    return {n: getattr(module, n) for n in names}


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    q |= _from(quality, ["dq_tag", "dq_valid_dedup", "dq_quarantine", "dq_all_violations",
                         "dq_metrics", "dq_all_failed_rules", "dq_report", "audit_log",
                         "dq_cross_column", "derived_rates", "fk_orphans", "union_missing_cols",
                         "bucket_case", "silver_balance", "dq_exact_copies", "fk_null_keys",
                         "union_widened", "status_cascade"])
    q |= _from(cdc, ["cdc_latest", "cdc_superseded", "cdc_merge", "cdc_delete_unknown",
                     "cdc_late_change", "scd2_new", "scd2_changed", "scd2_apply", "scd2_init",
                     "cdc_merge_incremental", "scd2_apply_incremental", "cdc_sequential", "cdc_out_of_order",
                     "live_view", "cdc_null_keys", "scd2_late", "history_overlaps",
                     "cdc_from_snapshots", "cdc_snapshot_replay"])
    q |= _from(star, ["sk_dense", "dim_order", "dim_from_fact", "dim_versions", "fact_temporal_join",
                      "chk_fact_grain", "fact_star_join", "fact_unknown_member", "fact_maintenance",
                      "cost_split", "date_shift", "dim_date", "sk_incremental", "fact_production",
                      "fact_asof_binned", "fact_dates_pruned"])
    q |= _from(governed, ["rls_scoped", "cls_mask", "chk_unmasked", "chk_rls_scope",
                          "chk_date_coverage", "chk_fk_left_null", "chk_reconcile", "chk_not_null",
                         "chk_reconcile_dups", "chk_schema", "view_sql", "rls_all"])
    q |= _from(gold, ["gold_fact_sensor", "gold_fact_production", "gold_fact_maintenance", "gold_validate",
                      "gold_key_runs", "gold_validate_broken",
                      "cleanse_telemetry", "cleanse_orders", "cleanse_maintenance", "cleanse_inspections"])
    q |= _from(io, ["json_roundtrip", "csv_roundtrip", "source_file", "conform_schema",
                    "stream_ingest", "stream_rerun", "layout_same_rows", "stream_dq_split",
                    "stream_dedup", "rescued_fields", "stream_cdc_apply", "stream_cdc_out_of_order",
                    "schema_evolution", "source_file_details", "layout_compact", "run_retry", "partitioned_write",
                    "snapshot_versions", "consolidate_tables", "stream_parquet_rescue", "stream_schema_log",
                    "required_quarantine", "stream_late_rows", "stream_ledger", "schema_inferred"])
    return q


def oracle_sql() -> dict[str, str]:
    q = queries()
    return {k: v for k, v in ORACLE.items() if k in q}
