"""Change-data-capture: latest change per key, and applying a change batch to a
current-state table with soft deletes — as one full outer join, no MERGE needed.

The target stores the `(ts, lsn)` of the change that produced each row, so a change
older than the stored state loses (late data cannot roll a row back), and applying
the same batch twice gives the same snapshot as applying it once. A NULL key is one key, so a
batch that holds it finds the row it inserted before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import latest, winners
from .joins import join_null_safe

# Change operations and the outcome labels of `apply_changes`.
INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"
UNTOUCHED, INSERTED, UPDATED, DELETED = "untouched", "inserted", "updated", "deleted"
IGNORED_LATE, IGNORED_UNKNOWN_DELETE = "ignored_late", "ignored_unknown_delete"


def latest_changes(log: DataFrame, keys: Sequence[str], order: Sequence[str] = ("ts", "lsn"),
                   with_superseded: bool = True):
    """Latest change per key under the total order (ts, lsn); optionally the superseded ones.

    Superseded changes are history, not duplicates (they are reported with action INFO).
    """
    if with_superseded:
        return latest(log, keys, order)
    return winners(log, keys, order)


def tombstone_snapshot(latest_log: DataFrame, op: str = "op", deletes: Sequence[str] = (DELETE,),
                       deleted_col: str = "is_deleted") -> DataFrame:
    """First load of a current-state table from a change log: deletes stay as tombstones."""
    return latest_log.withColumn(deleted_col, F.col(op).isin(*deletes)).drop(op)


def _newer(c_order: list[Column], t_order: list[Column]) -> Column:
    """Lexicographic (c_ts, c_lsn, ...) > (t_ts, t_lsn, ...); a NULL stored order loses."""
    expr = None
    for i in reversed(range(len(c_order))):
        gt = c_order[i] > t_order[i]
        step = gt if expr is None else gt | ((c_order[i] == t_order[i]) & expr)
        expr = t_order[i].isNull() | step
    return F.coalesce(expr, F.lit(False))


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str],
                  value_cols: Sequence[str] | None = None, order: Sequence[str] = ("ts", "lsn"),
                  op: str = "op", upserts: Sequence[str] = (INSERT, UPDATE),
                  deletes: Sequence[str] = (DELETE,), deleted_col: str = "is_deleted",
                  deleted_at_col: str | None = None, outcome_col: str | None = None) -> DataFrame:
    """New current-state snapshot = target ⟗ latest changes on the key.

    * upsert on a new key → inserted; on an existing key, if newer → updated and the
      soft-delete flag is cleared (a re-insert revives the row);
    * delete on an existing key, if newer → tombstone (values kept, flag set);
    * delete of an unknown key → ignored (no row); older-than-stored change → ignored;
    * `value_cols` defaults to every non-key, non-order column of `changes`.

    `changes` must hold at most one row per key (use `latest_changes` first).
    """
    keys, order = list(keys), list(order)
    if value_cols is None:
        value_cols = [c for c in changes.columns if c not in keys + order + [op]]
    value_cols = list(value_cols)
    tcols = value_cols + order + [deleted_col] + ([deleted_at_col] if deleted_at_col else [])
    tsel = [F.col(c).alias(f"__t_{c}") if c in target.columns else F.lit(None).alias(f"__t_{c}")
            for c in tcols]
    t = target.select(*keys, *tsel, F.lit(True).alias("__t"))
    c = changes.select(*keys, *[F.col(x).alias(f"__c_{x}") for x in value_cols + order + [op]],
                       F.lit(True).alias("__c"))
    j = join_null_safe(t, c, keys, "full_outer")

    has_t, has_c = F.col("__t").isNotNull(), F.col("__c").isNotNull()
    is_up = F.col(f"__c_{op}").isin(*upserts)
    is_del = F.col(f"__c_{op}").isin(*deletes)
    newer = ~has_t | _newer([F.col(f"__c_{x}") for x in order], [F.col(f"__t_{x}") for x in order])
    take_up = has_c & is_up & newer
    take_del = has_c & is_del & has_t & newer

    out = {}
    for v in value_cols:
        out[v] = F.when(take_up, F.col(f"__c_{v}")).otherwise(F.col(f"__t_{v}"))
    for o in order:
        out[o] = F.when(take_up | take_del, F.col(f"__c_{o}")).otherwise(F.col(f"__t_{o}"))
    out[deleted_col] = (F.when(take_up, F.lit(False)).when(take_del, F.lit(True))
                        .otherwise(F.coalesce(F.col(f"__t_{deleted_col}"), F.lit(False))))
    if deleted_at_col:
        out[deleted_at_col] = (F.when(take_up, F.lit(None)).when(take_del, F.col(f"__c_{order[0]}"))
                               .otherwise(F.col(f"__t_{deleted_at_col}"))).cast("timestamp")
    if outcome_col:
        out[outcome_col] = (F.when(~has_c, F.lit(UNTOUCHED))
                            .when(~has_t & is_up, F.lit(INSERTED))
                            .when(~has_t, F.lit(IGNORED_UNKNOWN_DELETE))
                            .when(take_up, F.lit(UPDATED)).when(take_del, F.lit(DELETED))
                            .otherwise(F.lit(IGNORED_LATE)))
    keep = has_t | (has_c & is_up)
    return j.filter(keep).select(*keys, *[e.alias(n) for n, e in out.items()])


def unknown_deletes(target: DataFrame, changes: DataFrame, keys: Sequence[str], op: str = "op",
                    deletes: Sequence[str] = (DELETE,)) -> DataFrame:
    """Deletes whose key the target never held (reported, not applied)."""
    d = changes.filter(F.col(op).isin(*deletes))
    return join_null_safe(d, target.select(*keys).distinct(), list(keys), "left_anti")


UPSERT_ORDER_PREFIX = "_up_"


def apply_changes_sequential(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                             value_cols: Sequence[str], order: Sequence[str] = ("ts", "lsn"),
                             op: str = "op", upserts: Sequence[str] = (INSERT, UPDATE),
                             deletes: Sequence[str] = (DELETE,), deleted_col: str = "is_deleted",
                             deleted_at_col: str | None = None,
                             keep_unknown_deletes: bool = False) -> DataFrame:
    """Apply a batch with *several* changes per key as if they came one at a time in
    (ts, lsn) order — e.g. an insert followed by a delete inside one batch leaves a
    tombstone instead of nothing.

    Each row holds two last-writer-wins registers: the last change (its `order` and
    whether it was a delete) and the last upsert (the values and their order, stored in
    `_up_<order col>`). A batch is collapsed per key by aggregation (partial, skew-safe)
    and merged by taking the newer of each register, so the merge is idempotent, and —
    with `keep_unknown_deletes=True`, which keeps a delete of a never-seen key as a
    value-less tombstone — independent of the order in which batches arrive.
    A target without `_up_*` columns is read as if its last upsert were its last change.
    """
    keys, order, value_cols = list(keys), list(order), list(value_cols)
    up_cols = [UPSERT_ORDER_PREFIX + o for o in order]
    ordkey = F.struct(*[F.col(c) for c in order])
    is_up = F.col(op).isin(*upserts)
    collapsed = batch.groupBy(*keys).agg(
        F.max(F.struct(*[F.col(c) for c in order], F.col(op).alias("__op"))).alias("__last"),
        F.max_by(F.struct(*[F.col(c) for c in value_cols + order]), F.when(is_up, ordkey)).alias("__up"))
    c = collapsed.select(
        *keys, *[F.col("__last")[o].alias(f"__c_{o}") for o in order],
        F.col("__last")["__op"].alias("__c_op"),
        *[F.col("__up")[v].alias(f"__u_{v}") for v in value_cols],
        *[F.col("__up")[o].alias(f"__u_{o}") for o in order],
        F.col("__up").isNotNull().alias("__has_up"), F.lit(True).alias("__c"))

    def tcol(x, fallback=None):
        if x in target.columns:
            return F.col(x)
        return F.col(fallback) if fallback and fallback in target.columns else F.lit(None)

    tcols = value_cols + order + [deleted_col] + ([deleted_at_col] if deleted_at_col else [])
    t = target.select(*keys, *[tcol(x).alias(f"__t_{x}") for x in tcols],
                      *[tcol(u, o).alias(f"__tu_{o}") for u, o in zip(up_cols, order)],
                      F.lit(True).alias("__t"))
    j = join_null_safe(t, c, keys, "full_outer")

    has_t, has_c = F.col("__t").isNotNull(), F.col("__c").isNotNull()
    has_up = F.coalesce(F.col("__has_up"), F.lit(False))
    c_del = F.col("__c_op").isin(*deletes)
    last_newer = has_c & (~has_t | _newer([F.col(f"__c_{o}") for o in order],
                                          [F.col(f"__t_{o}") for o in order]))
    up_newer = has_up & (~has_t | _newer([F.col(f"__u_{o}") for o in order],
                                         [F.col(f"__tu_{o}") for o in order]))

    out = {v: F.when(up_newer, F.col(f"__u_{v}")).otherwise(F.col(f"__t_{v}")) for v in value_cols}
    for o in order:
        out[o] = F.when(last_newer, F.col(f"__c_{o}")).otherwise(F.col(f"__t_{o}"))
    for u, o in zip(up_cols, order):
        out[u] = F.when(up_newer, F.col(f"__u_{o}")).otherwise(F.col(f"__tu_{o}"))
    out[deleted_col] = F.when(last_newer, c_del).otherwise(F.coalesce(F.col(f"__t_{deleted_col}"), F.lit(False)))
    if deleted_at_col:
        out[deleted_at_col] = (F.when(last_newer & c_del, F.col(f"__c_{order[0]}"))
                               .when(last_newer, F.lit(None))
                               .otherwise(F.col(f"__t_{deleted_at_col}"))).cast("timestamp")
    keep = has_t | has_up | (has_c & F.lit(keep_unknown_deletes))
    return j.filter(keep).select(*keys, *[e.alias(n) for n, e in out.items()])
