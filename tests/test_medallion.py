from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata import medallion
from strata.operators import checks
from strata.sources import writers


def test_layered_run_is_rerunnable_and_checks_pass(spark, scratch):
    out = scratch("lake")
    ctx = medallion.default_context("run-1")
    led = medallion.run(spark, SF_SMALL, out, ctx)
    assert [r.status for r in led.collect()] == ["OK"] * 9
    medallion.run(spark, SF_SMALL, out, ctx)                   # same run again: replaces
    n_events = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert spark.read.parquet(f"{out}/bronze/events").count() == n_events
    res = spark.read.parquet(f"{out}/checks")
    checks.enforce(res)                                         # no ERROR check failed
    silver = spark.read.parquet(f"{out}/silver/telemetry")
    assert silver.count() == n_events                           # every row has a disposition
    # next run versions suppliers against the previous snapshot: nothing changed
    prev = f"{out}/silver/equipment/{writers.RUN_COL}=run-1"
    ctx2 = medallion.default_context("run-2")
    medallion.run(spark, SF_SMALL, out, ctx2, previous_equipment=prev)
    eq = spark.read.parquet(f"{out}/silver/equipment").filter(F.col(writers.RUN_COL) == "run-2")
    n_sup = spark.read.parquet(f"{SF_SMALL}/supplier.parquet").count()
    assert eq.count() == n_sup and eq.filter("is_current").count() == n_sup


def test_failed_step_is_in_the_ledger_and_order_keys_stay(spark, scratch):
    import pytest
    out = scratch("lake")
    ctx = medallion.default_context("run-1")
    with pytest.raises(Exception):
        medallion.run(spark, SF_SMALL, out, ctx, previous_orders=scratch("nowhere"))
    led = {r.step: r.status for r in spark.read.parquet(f"{out}/ledger").collect()}
    assert led["gold_dim_order"] == "FAILED" and led["bronze_events"] == "OK" and "checks" not in led
    medallion.run(spark, SF_SMALL, out, ctx)
    first = f"{out}/gold/dim_order/{writers.RUN_COL}=run-1"
    medallion.run(spark, SF_SMALL, out, medallion.default_context("run-2"), previous_orders=first)
    both = spark.read.parquet(f"{out}/gold/dim_order").groupBy("order_id").agg(F.count_distinct("order_sk").alias("n"))
    assert both.filter("n <> 1").count() == 0
