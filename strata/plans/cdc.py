"""Change-capture and history proofs (events as a change log, supplier as a versioned entity)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..operators import changes, difference, history, snapshots
from ..session import scratch_path
from .fixtures import CDC_SPLIT, LATE_STATE_TYPES, change_log, part_versions
from .tables import Tables

ORDER = ("ts", "lsn")
SUPERSEDED_RULE = "DQ-MR-002"
# Fixed values of the history proofs: first-load day, change day, tracked columns,
# keys whose balance the incoming snapshot changes (every 7th) and keys absent from
# the first load (suffix 3 of 10).
SCD_FIRST_LOAD = _dt.date(2026, 1, 1)
SCD_CHANGE_DAY = _dt.date(2026, 2, 1)
SCD_NEW_DIGIT = 3
SCD_TRACKED = ("s_name", "s_nationkey", "bal")


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


def _cdc(spark, sf_dir):
    log = change_log(Tables(spark, sf_dir).events)
    early = F.col("ts") < _ts(CDC_SPLIT)
    base = changes.tombstone_snapshot(changes.latest_changes(log.filter(early), ["k"], ORDER, False))
    return base, log.filter(~early)


def _latest_increment(spark, sf_dir):
    base, inc = _cdc(spark, sf_dir)
    return base, changes.latest_changes(inc, ["k"], ORDER, False)


def cdc_latest(spark, sf_dir):
    _, inc = _latest_increment(spark, sf_dir)
    return inc.select("k", "lsn", "op", "value")


def cdc_superseded(spark, sf_dir):
    _, inc = _cdc(spark, sf_dir)
    _, sup = changes.latest_changes(inc, ["k"], ORDER)
    return sup.select("k", "lsn", F.lit(SUPERSEDED_RULE).alias("reason"))


def cdc_merge(spark, sf_dir):
    base, inc = _latest_increment(spark, sf_dir)
    snap = changes.apply_changes(base, inc, ["k"], value_cols=["value"], order=ORDER)
    return snap.select("k", "value", "is_deleted")


def cdc_delete_unknown(spark, sf_dir):
    base, inc = _latest_increment(spark, sf_dir)
    return changes.unknown_deletes(base, inc, ["k"]).agg(F.count(F.lit(1)).alias("n"))


def cdc_late_change(spark, sf_dir):
    """Changes of some sources arrive after those of others: older ones than the stored state lose."""
    ev = Tables(spark, sf_dir).events
    cols = [F.col("user_id").alias("k"), F.col("event_id").alias("lsn"), "ts", "value"]
    stored = F.col("event_type").isin(*LATE_STATE_TYPES)
    state = changes.latest_changes(ev.filter(stored).select(*cols), ["k"], ORDER, False)
    batch = changes.latest_changes(ev.filter(~stored).select(*cols), ["k"], ORDER, False)
    snap = changes.apply_changes(state, batch.withColumn("op", F.lit(changes.UPDATE)), ["k"], value_cols=["value"],
                                 order=ORDER, outcome_col="outcome")
    return snap.select("k", "value", "outcome")


# Fixed value: every user whose id ends in this digit is a change of the NULL key.
NULL_KEY_DIGIT = 3


def cdc_null_keys(spark, sf_dir):
    """The log with NULL keys applied twice: NULL is one key, and the second time changes nothing."""
    log = change_log(Tables(spark, sf_dir).events).withColumn(
        "k", F.when(F.col("k") % 10 != NULL_KEY_DIGIT, F.col("k")))
    batch = changes.latest_changes(log, ["k"], ORDER, False)
    empty = log.limit(0).select("k", "value", "ts", "lsn", F.lit(False).alias("is_deleted"))
    once = changes.apply_changes(empty, batch, ["k"], value_cols=["value"], order=ORDER)
    twice = changes.apply_changes(once, batch, ["k"], value_cols=["value"], order=ORDER)
    return twice.select("k", "value", "is_deleted")


def _suppliers(spark, sf_dir):
    s = Tables(spark, sf_dir).supplier
    bal = F.col("s_acctbal").cast("decimal(12,2)")
    incoming = s.select(F.col("s_suppkey").alias("k"), "s_name", "s_nationkey",
                        F.when(F.col("s_suppkey") % 7 == 0, bal + 1).otherwise(bal).alias("bal"))
    first = s.filter(F.col("s_suppkey") % 10 != SCD_NEW_DIGIT).select(
        F.col("s_suppkey").alias("k"), "s_name", "s_nationkey", bal.alias("bal"))
    target = history.apply(None, first, ["k"], SCD_TRACKED, as_of=SCD_FIRST_LOAD,
                           initial_start=SCD_FIRST_LOAD)
    return target, incoming


def scd2_new(spark, sf_dir):
    target, incoming = _suppliers(spark, sf_dir)
    new, _ = history.detect(target, incoming, ["k"], SCD_TRACKED)
    return new.select("k", F.col(history.HASH).alias("h"))


def scd2_changed(spark, sf_dir):
    target, incoming = _suppliers(spark, sf_dir)
    _, changed = history.detect(target, incoming, ["k"], SCD_TRACKED)
    return changed.select("k", "old_h", "new_h")


def scd2_apply(spark, sf_dir):
    target, incoming = _suppliers(spark, sf_dir)
    snap = history.apply(target, incoming, ["k"], SCD_TRACKED, as_of=SCD_CHANGE_DAY)
    return snap.select("k", "bal", F.col(history.START).alias("start_date"),
                       F.col(history.END).alias("end_date"), "is_current",
                       F.col(history.VERSION).alias("version"))


def scd2_init(spark, sf_dir):
    s = Tables(spark, sf_dir).supplier.select(
        F.col("s_suppkey").alias("k"), F.col("s_acctbal").cast("decimal(12,2)").alias("bal"))
    snap = history.apply(None, s, ["k"], ["bal"], as_of=SCD_CHANGE_DAY)
    return snap.select("k", "bal", F.col(history.START).alias("start_date"),
                       F.col(history.END).alias("end_date"), "is_current",
                       F.col(history.VERSION).alias("version"))


def cdc_merge_incremental(spark, sf_dir):
    """Same result as cdc_merge, applied to a stored current state as its next snapshot."""
    base, inc = _latest_increment(spark, sf_dir)
    path = scratch_path(spark, "cdc-state")
    snapshots.advance(spark, path, base, lambda cur, b: b, base.schema)
    plan = lambda cur, b: changes.apply_changes(cur, b, ["k"], value_cols=["value"], order=ORDER)
    snapshots.advance(spark, path, inc, plan, base.schema)
    return snapshots.read(spark, path, base.schema).select("k", "value", "is_deleted")


def scd2_apply_incremental(spark, sf_dir):
    """Same result as scd2_apply, applied to a stored history as its next snapshot."""
    target, incoming = _suppliers(spark, sf_dir)
    # the stored table is declared wide enough for the incoming balances (+1 may need
    # one more digit); the hash text of a decimal does not depend on its precision
    target = target.withColumn("bal", F.col("bal").cast(incoming.schema["bal"].dataType))
    path = scratch_path(spark, "scd-state")
    snapshots.advance(spark, path, target, lambda cur, b: b, target.schema)
    plan = lambda cur, b: history.apply(cur, b, ["k"], SCD_TRACKED, as_of=SCD_CHANGE_DAY)
    snapshots.advance(spark, path, incoming, plan, target.schema)
    snap = snapshots.read(spark, path, target.schema)
    return snap.select("k", "bal", F.col(history.START).alias("start_date"),
                       F.col(history.END).alias("end_date"), "is_current",
                       F.col(history.VERSION).alias("version"))


def scd2_late(spark, sf_dir):
    """A snapshot dated before the first load closes nothing: every version stays open."""
    target, incoming = _suppliers(spark, sf_dir)
    before = SCD_FIRST_LOAD - _dt.timedelta(days=1)
    known = incoming.filter(F.col("k") % 10 != SCD_NEW_DIGIT)     # no new keys here
    snap = history.apply(target, known, ["k"], SCD_TRACKED, as_of=before)
    late = history.late(target, known, ["k"], SCD_TRACKED, before).select("k", F.lit(True).alias("late"))
    return (snap.join(late, "k", "left")
            .select("k", F.col("bal").cast("decimal(12,2)").alias("bal"), "is_current", F.coalesce("late", F.lit(False)).alias("late")))


def history_overlaps(spark, sf_dir):
    """Version numbers with repeats (every version stored twice) and gaps (second versions called 5):
    versions that run into their successor."""
    v = part_versions(Tables(spark, sf_dir).part).withColumn("ver", F.when(F.col("ver") == 2, 5).otherwise(F.col("ver")))
    bad = history.overlaps(v.unionByName(v), ["p_partkey"], "st", "en", "ver")
    return bad.groupBy("p_partkey", "ver").agg(F.count(F.lit(1)).alias("n"))


def cdc_sequential(spark, sf_dir):
    """The whole change log applied as one batch to an empty table, with the result of
    applying its changes one at a time (an insert later deleted stays as a tombstone)."""
    log = change_log(Tables(spark, sf_dir).events)
    empty = log.limit(0).select("k", "value", "ts", "lsn", F.lit(False).alias("is_deleted"))
    snap = changes.apply_changes_sequential(empty, log, ["k"], ["value"], order=ORDER)
    return snap.select("k", "value", "is_deleted")


def live_view(spark, sf_dir):
    """Analyst view of the merged snapshot: soft-deleted rows hidden (by option)."""
    from ..operators import governance
    base, inc = _latest_increment(spark, sf_dir)
    snap = changes.apply_changes(base, inc, ["k"], value_cols=["value"], order=ORDER)
    return governance.governed_view(snap.select("k", "value", "is_deleted")).select("k", "value")


# Fixed value: the (deliberately not chronological) order in which the per-event-type
# batches of the change log arrive: all deletes first, inserts last.
ARRIVAL_ORDER = ("error", "purchase", "view", "click", "signup")


def cdc_out_of_order(spark, sf_dir):
    """The whole change log applied as five batches that arrive out of time order
    (deletes before the inserts they follow); the two-register merge with kept unknown
    deletes gives the same state as applying every change in (ts, lsn) order."""
    ev = Tables(spark, sf_dir).events
    log = change_log(ev.withColumn("batch", F.col("event_type")), carry=("batch",))
    empty = log.limit(0).select("k", "value", "ts", "lsn", F.lit(False).alias("is_deleted"))
    state = empty
    for b in ARRIVAL_ORDER:
        batch = log.filter(F.col("batch") == b).drop("batch")
        state = changes.apply_changes_sequential(state, batch, ["k"], ["value"], order=ORDER,
                                                 keep_unknown_deletes=True)
    return state.select("k", "value", "is_deleted")


# Fixed values of the difference proofs: the columns compared, and the instant of the derived events.
DIFF_TRACKED = ("value", "event_type")
DIFF_TS = "2100-01-01 00:00:00"


def _two_states(spark, sf_dir):
    """The state before CDC_SPLIT and the one after all changes."""
    log = change_log(Tables(spark, sf_dir).events, carry=("event_type",))
    early = F.col("ts") < _ts(CDC_SPLIT)
    before = changes.tombstone_snapshot(changes.latest_changes(log.filter(early), ["k"], ORDER, False))
    batch = changes.latest_changes(log.filter(~early), ["k"], ORDER, False)
    return before, changes.apply_changes(before, batch, ["k"], value_cols=DIFF_TRACKED, order=ORDER)


def _difference(before, after):
    return difference.snapshot_changes(before, after, ["k"], DIFF_TRACKED, deleted_col="is_deleted",
                                       stamp={"ts": _ts(DIFF_TS), "lsn": F.lit(0).cast("long")})


def cdc_from_snapshots(spark, sf_dir):
    """Events derived from two states: inserts, deletes, and updates with the names that changed."""
    events = _difference(*_two_states(spark, sf_dir))
    return events.select("k", *DIFF_TRACKED, "op", F.array_join(difference.CHANGED, ",").alias("changed"))


def cdc_snapshot_replay(spark, sf_dir):
    """The derived events applied to the first state give the second."""
    before, after = _two_states(spark, sf_dir)
    again = changes.apply_changes(before, _difference(before, after), ["k"], value_cols=DIFF_TRACKED, order=ORDER)
    return again.where("not is_deleted").select("k", *DIFF_TRACKED)
