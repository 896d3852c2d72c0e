"""An end-to-end layered run over the driver tables, composed from the library:
bronze (lineage, run-keyed) → silver (classified telemetry, violations, change-log
snapshot, versioned suppliers) → gold (date and order dimensions, line fact) → checks
→ audit and ledger. Every step is an ordinary function call sharing one RunContext;
state passes through the written tables only, and re-running the same run id
replaces that run's output instead of appending it again.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .context import RunContext
from .functions.dates import date_key
from .operators import changes, checks, history, keys, model, report
from .operators import rules as R
from .plans import quality
from .plans.fixtures import change_log, telemetry
from .plans.tables import Tables
from .sources import readers, writers

ORDER = ("ts", "lsn")


def _path(out: str, *parts: str) -> str:
    return "/".join([out.rstrip("/"), *parts])


def _this_run(spark: SparkSession, path: str, ctx: RunContext) -> DataFrame:
    """Only this run's partition (partition pruning), never the whole history."""
    return spark.read.parquet(path).filter(F.col(writers.RUN_COL) == ctx.run_id)


def run(spark: SparkSession, sf_dir: str, out: str, ctx: RunContext,
        previous_equipment: str | None = None, previous_orders: str | None = None) -> DataFrame:
    """One run; returns its ledger, which is written also when a step fails (status FAILED).
    `previous_equipment` / `previous_orders`: an earlier run's folders, whose versions and
    surrogate keys go on (an order keeps its key in every run)."""
    ledger = report.Ledger(ctx)
    try:
        _run(spark, sf_dir, out, ctx, ledger, previous_equipment, previous_orders)
    finally:
        led = ledger.to_df(spark)
        writers.write_run(led, _path(out, "ledger"), ctx.run_id)
    return led


def _run(spark, sf_dir, out, ctx, ledger, previous_equipment, previous_orders) -> None:
    t = Tables(spark, sf_dir)
    audits: list[DataFrame] = []

    # bronze: raw rows + lineage, keyed by run
    with ledger.step("bronze_events") as s:
        bronze = readers.with_lineage(t.events, ingest_ts=F.lit(ctx.as_of).cast("timestamp"))
        observed, obs = report.observe_counts(bronze, "bronze_events")
        writers.write_run(observed, _path(out, "bronze", "events"), ctx.run_id)
        s["rows_out"] = obs.get["rows"]

    # silver: one classified write, counts from the same job
    with ledger.step("silver_telemetry") as s:
        raw = telemetry(_this_run(spark, _path(out, "bronze", "events"), ctx)) \
            .withColumn("event_date", F.to_date("ts"))
        classified = R.classify(raw, quality.telemetry_rules(), quality.KEYS, quality.ORDER)
        m = R.write_classified(classified, _path(out, "silver", "telemetry"), ctx)
        s["rows_in"], s["rows_out"] = m["n_in"], m["n_valid"]
    silver = _this_run(spark, _path(out, "silver", "telemetry"), ctx)
    audits.append(report.audit_rows(
        silver.filter(F.col(R.DISPOSITION) == R.VALID).agg(F.count(F.lit(1)).alias("n_valid")),
        ctx, "silver.telemetry"))

    with ledger.step("silver_violations") as s:
        v = report.union_all([
            R.all_violations(silver, "telemetry", "device_id", quality.DUPLICATE_RULE, "event_id", ctx=ctx),
            checks.fk_violations(t.orders, t.lineitem, "o_orderkey", "l_orderkey", "orders", "DQ-010", ctx=ctx),
        ])
        observed, obs = report.observe_counts(v, "violations")
        writers.write_run(observed, _path(out, "silver", "violations"), ctx.run_id)
        s["rows_out"] = obs.get["rows"]

    # silver: current state from the change log (soft deletes), one snapshot per run
    with ledger.step("silver_maintenance") as s:
        log = change_log(t.events)
        latest = changes.latest_changes(log, ["k"], ORDER, with_superseded=False)
        empty = latest.limit(0).select("k", "value", "ts", "lsn", F.lit(False).alias("is_deleted"))
        snap = changes.apply_changes(empty, latest, ["k"], value_cols=["value"], order=ORDER,
                                     deleted_at_col="deleted_at")
        writers.write_run(snap, _path(out, "silver", "maintenance"), ctx.run_id)

    # silver: versioned suppliers (SCD2 against the previous snapshot, if any)
    with ledger.step("silver_equipment") as s:
        src = t.supplier.select(F.col("s_suppkey").alias("equipment_id"), "s_name", "s_nationkey",
                                F.col("s_acctbal").cast("decimal(12,2)").alias("asset_value"))
        prev = spark.read.parquet(previous_equipment).drop(writers.RUN_COL) if previous_equipment else None
        eq = history.apply(prev, src, ["equipment_id"], ["s_name", "s_nationkey", "asset_value"],
                           as_of=ctx.as_of_date)
        writers.write_run(eq, _path(out, "silver", "equipment"), ctx.run_id)

    # gold: dimensions with surrogate keys, then the fact
    with ledger.step("gold_dim_date") as s:
        bounds = t.orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
        dd = model.date_dimension(model.date_spine(bounds, "lo", "hi"))
        writers.write_run(dd, _path(out, "gold", "dim_date"), ctx.run_id)
    with ledger.step("gold_dim_order") as s:
        rows = t.orders.select(F.col("o_orderkey").alias("order_id"),
                               F.col("o_orderpriority").alias("priority"),
                               F.to_date("o_orderdate").alias("planned_start_date"))
        known = spark.read.parquet(previous_orders).select("order_id", "order_sk") if previous_orders else None
        writers.write_run(keys.assign_keys(rows, ["order_id"], "order_sk", known),
                          _path(out, "gold", "dim_order"), ctx.run_id)
    with ledger.step("gold_fact_line") as s:
        dim_order = _this_run(spark, _path(out, "gold", "dim_order"), ctx).select("order_id", "order_sk")
        fact = model.lookup_keys(t.lineitem, dim_order, "l_orderkey", "order_id", "order_sk")
        fact = fact.select("order_sk", "l_linenumber", "l_partkey", "l_suppkey",
                           date_key("l_shipdate").alias("timestamp_sk"), "l_quantity", "l_extendedprice")
        observed, obs = report.observe_counts(fact, "fact_line")
        writers.write_run(observed, _path(out, "gold", "fact_line"), ctx.run_id)
        s["rows_out"] = obs.get["rows"]

    # checks: counts, FK coverage, date coverage, NOT NULL keys
    with ledger.step("checks") as s:
        fact = _this_run(spark, _path(out, "gold", "fact_line"), ctx)
        dim_date = _this_run(spark, _path(out, "gold", "dim_date"), ctx)
        results = report.union_all([
            checks.check_row("reconcile_missing", "bronze.events", "WARN",
                             checks.reconcile(t.events, _this_run(spark, _path(out, "bronze", "events"), ctx),
                                              ["event_id"]).withColumn("n", F.col("n_missing") + F.col("n_extra")), ctx),
            checks.check_row("fk_unknown_order", "gold.fact_line", "ERROR",
                             fact.agg(F.count_if(F.col("order_sk") == model.UNKNOWN_SK).alias("n")), ctx),
            checks.check_row("not_null_keys", "gold.fact_line", "ERROR",
                             checks.null_counts(fact, ["order_sk", "timestamp_sk"])
                             .select((F.col("order_sk") + F.col("timestamp_sk")).alias("n")), ctx),
            checks.check_row("order_date_coverage", "gold.dim_date", "ERROR",
                             checks.missing_dates(t.orders, "o_orderdate", dim_date, "date_day")
                             .agg(F.count(F.lit(1)).alias("n")), ctx),
        ])
        observed, obs = report.observe_counts(results, "checks")
        writers.write_run(observed, _path(out, "checks"), ctx.run_id)
        s["rows_out"] = obs.get["rows"]

    writers.write_run(report.union_all(audits), _path(out, "audit"), ctx.run_id)


def default_context(run_id: str) -> RunContext:
    return RunContext(run_id=run_id, as_of=_dt.datetime(2026, 2, 1), principal="system")


def main(argv=None):
    import argparse

    from .session import local_session, scratch_path
    p = argparse.ArgumentParser(description="layered run over the driver tables")
    p.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    p.add_argument("--out", default=None, help="output folder (default: new folder under the checkpoint dir)")
    p.add_argument("--run-id", default="run-1")
    p.add_argument("--previous-equipment", default=None)
    p.add_argument("--previous-orders", default=None, help="an earlier run's dim_order, whose keys go on")
    a = p.parse_args(argv)
    spark = local_session()
    out = a.out or scratch_path(spark, "lake")
    led = run(spark, a.sf_dir, out, default_context(a.run_id), a.previous_equipment, a.previous_orders)
    led.show(truncate=False)
    print(f"output: {out}")


if __name__ == "__main__":
    main()
