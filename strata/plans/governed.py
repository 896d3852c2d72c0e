"""Governed-view and check proofs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expressions import mask_prefix
from ..operators import checks, governance
from .fixtures import telemetry
from .tables import Tables

# The analyst principal of the proof, its region, mask shape, and the
# modulus that makes the reconciliation target a lossy copy (every 50th order lost).
ANALYST = "analyst_europe"
ANALYST_REGION = "EUROPE"
MASK_KEEP, MASK_SUFFIX = 5, "***"
LOSSY_EVERY = 50


def entitlements(t: Tables):
    """principal → nation keys, derived from region membership: analyst_<region>."""
    reg = t.region.select("r_regionkey", F.concat(F.lit("analyst_"), F.lower("r_name")).alias("principal"))
    return t.nation.join(reg, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "principal", F.col("n_nationkey").alias("scope_value"))


def rls_scoped(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c = t.customer.select("c_custkey", "c_nationkey")
    return governance.row_scope(c, "c_nationkey", entitlements(t), ANALYST)


def _masked_customers(t: Tables):
    return governance.mask_columns(t.customer.select("c_custkey", "c_name", "c_acctbal"),
                                   {"c_name": lambda c: mask_prefix(c, MASK_KEEP, MASK_SUFFIX)})


def cls_mask(spark, sf_dir):
    return _masked_customers(Tables(spark, sf_dir))


def chk_unmasked(spark, sf_dir):
    return checks.unmasked_count(_masked_customers(Tables(spark, sf_dir)), "c_name", MASK_SUFFIX)


def chk_rls_scope(spark, sf_dir):
    t = Tables(spark, sf_dir)
    scoped = governance.row_scope(t.customer, "c_nationkey", entitlements(t), ANALYST)
    j = scoped.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return checks.distinct_count(j, "r_regionkey")


def chk_date_coverage(spark, sf_dir):
    t = Tables(spark, sf_dir)
    miss = checks.missing_dates(t.orders, "o_orderdate", t.lineitem, "l_shipdate")
    return miss.agg(F.count(F.lit(1)).alias("n"))


def chk_fk_left_null(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return checks.count_orphans(t.orders, t.lineitem, "o_orderkey", "l_orderkey")


def chk_reconcile(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    copy = o.filter(F.col("o_orderkey") % LOSSY_EVERY != 0)
    return checks.reconcile(o, copy, ["o_orderkey"])


def chk_reconcile_dups(spark, sf_dir):
    """Source with every order twice and some NULL keys, target with each once: lost copies count."""
    o = Tables(spark, sf_dir).orders.select(
        F.when(F.col("o_orderkey") % LOSSY_EVERY != 0, F.col("o_orderkey")).alias("o_orderkey"))
    return checks.reconcile(o.unionByName(o), o, ["o_orderkey"])


# Fixed value: columns every landed event must have (the last is not in the table).
EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "loaded_at")


def chk_schema(spark, sf_dir):
    """Missing and unexpected columns of the landed events, with the rows they concern."""
    ev = Tables(spark, sf_dir).events
    gaps = checks.schema_gaps(ev, EVENT_COLUMNS)
    return ev.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(",".join(gaps["missing"])).alias("missing"), F.lit(",".join(gaps["unexpected"])).alias("unexpected"),
        "n_rows")


def view_sql(spark, sf_dir):
    """Published view filtered by a SQL scope function of the current user."""
    t = Tables(spark, sf_dir)
    user = spark.sql("select current_user()").first()[0]
    governance.register_scope_function(spark, "strata_scope", {user: ANALYST_REGION})
    governance.publish_view(spark, "strata_customers", t.customer.join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey")))
    return spark.sql("select c_custkey, c_nationkey from strata_customers where r_name = strata_scope()")


def rls_all(spark, sf_dir):
    """A principal entitled to everything, and one entitled to nothing."""
    t = Tables(spark, sf_dir)
    ent = entitlements(t).select("principal", F.col("scope_value").cast("string").alias("scope_value"))
    ent = ent.unionByName(ent.limit(1).select(F.lit("auditor").alias("principal"),
                                              F.lit(governance.ALL).alias("scope_value")))
    c = t.customer.select("c_custkey", "c_nationkey")
    seen = [governance.row_scope(c, "c_nationkey", ent, who).agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(who).alias("principal"), "n") for who in ("auditor", "nobody")]
    return seen[0].unionByName(seen[1])


def chk_not_null(spark, sf_dir):
    raw = telemetry(Tables(spark, sf_dir).events)
    return checks.null_counts(raw, ["device_id", "facility_id", "ts"])
