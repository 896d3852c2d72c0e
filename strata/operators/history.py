"""Type-2 history (SCD2): detect new and changed keys by row hash, close the old
version and open the next one — one plan from the old snapshot to the new one.

Only current versions take part in the join; closed history passes through untouched.
The row hash is kept on every version and compared NULL-safely, so a key that changed
once is still seen to change again (a dropped hash compared with `<>` is NULL forever).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import row_hash
from .dedup import winners
from .joins import join_null_safe

START, END, CURRENT, VERSION, HASH = ("effective_start_date", "effective_end_date", "is_current",
                                      "version_number", "row_hash")
# Fixed value: default start of a first version, far in the past, so that facts dated
# before the first load still find a version.
INITIAL_START = _dt.date(1900, 1, 1)


def with_hash(df: DataFrame, tracked: Sequence[str], hash_col: str = HASH) -> DataFrame:
    return df.withColumn(hash_col, row_hash(list(tracked)))


def initial_load(source: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                 start: _dt.date = INITIAL_START, hash_col: str = HASH) -> DataFrame:
    """Version 1 of every key, open-ended and current."""
    return with_hash(source, tracked, hash_col).withColumns({
        START: F.lit(start).cast("date"), END: F.lit(None).cast("date"),
        CURRENT: F.lit(True), VERSION: F.lit(1)})


def _target_hash(target: DataFrame, tracked, hash_col):
    h = row_hash(list(tracked))
    return F.coalesce(F.col(hash_col), h) if hash_col in target.columns else h


def detect(target: DataFrame, source: DataFrame, keys: Sequence[str], tracked: Sequence[str],
           hash_col: str = HASH) -> tuple[DataFrame, DataFrame]:
    """(new keys, changed keys) of `source` against the current versions of `target`.

    changed carries `old_h` (stored) and `new_h` (incoming).
    """
    keys = list(keys)
    cur = target.filter(F.col(CURRENT)) if CURRENT in target.columns else target
    cur = cur.select(*keys, _target_hash(cur, tracked, hash_col).alias("old_h"))
    src = with_hash(source, tracked, hash_col)
    new = join_null_safe(src, cur, keys, "left_anti")
    changed = (join_null_safe(src, cur, keys, "inner")
               .filter(~F.col(hash_col).eqNullSafe(F.col("old_h")))
               .withColumnRenamed(hash_col, "new_h"))
    return new, changed


def apply(target: DataFrame | None, source: DataFrame, keys: Sequence[str], tracked: Sequence[str],
          as_of: _dt.date, attrs: Sequence[str] | None = None, hash_col: str = HASH,
          source_order: Sequence[str] | None = None,
          initial_start: _dt.date = INITIAL_START) -> DataFrame:
    """New snapshot of a versioned table.

    * `source` is the incoming state; if it may hold several rows per key pass
      `source_order` (total order, latest wins) and it is reduced first;
    * a change closes the current version on `as_of` (half-open `[start, end)`) and
      opens version n+1 from `as_of`; a new key opens version 1 from `as_of`;
    * keys absent from `source` stay as they are; closed versions pass through;
    * a snapshot older than a key's open version (`as_of` before its start) cannot close it:
      the version stays, and `late` lists such keys;
    * `target=None` is the first load: version 1 from `initial_start`.
    """
    keys = list(keys)
    attrs = list(attrs) if attrs is not None else [c for c in source.columns if c not in keys]
    if source_order:
        source = winners(source, keys, source_order)
    source = source.select(*keys, *attrs)
    if target is None:
        return initial_load(source, keys, tracked, initial_start, hash_col)

    hist = target.filter(~F.col(CURRENT))
    hist = hist.withColumn(hash_col, _target_hash(hist, tracked, hash_col))
    cur = target.filter(F.col(CURRENT))
    cur = cur.withColumn(hash_col, _target_hash(cur, tracked, hash_col))
    t = cur.select(*keys, *[F.col(c).alias(f"__t_{c}") for c in attrs + [hash_col, START, END, VERSION]],
                   F.lit(True).alias("__t"))
    s = with_hash(source, tracked, hash_col).select(
        *keys, *[F.col(c).alias(f"__s_{c}") for c in attrs + [hash_col]], F.lit(True).alias("__s"))
    j = join_null_safe(t, s, keys, "full_outer")
    has_t, has_s = F.col("__t").isNotNull(), F.col("__s").isNotNull()
    same = F.col(f"__t_{hash_col}").eqNullSafe(F.col(f"__s_{hash_col}"))
    day = F.lit(as_of).cast("date")

    def version_struct(prefix, start, end, current, version):
        return F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in attrs + [hash_col]],
                        start.alias(START), end.cast("date").alias(END),
                        current.alias(CURRENT), version.cast("int").alias(VERSION))

    old_kept = version_struct("__t_", F.col(f"__t_{START}"), F.col(f"__t_{END}"), F.lit(True),
                              F.col(f"__t_{VERSION}"))
    old_closed = version_struct("__t_", F.col(f"__t_{START}"), day, F.lit(False), F.col(f"__t_{VERSION}"))
    opened = version_struct("__s_", day, F.lit(None), F.lit(True),
                            F.coalesce(F.col(f"__t_{VERSION}") + 1, F.lit(1)))
    behind = day < F.col(f"__t_{START}")
    rows = (F.when(has_t & (~has_s | same | F.coalesce(behind, F.lit(False))), F.array(old_kept))
            .when(has_t, F.array(old_closed, opened))
            .otherwise(F.array(opened)))
    out = j.select(*keys, F.explode(rows).alias("__v")).select(*keys, "__v.*")
    return hist.select(*out.columns).unionByName(out)


def late(target: DataFrame, source: DataFrame, keys: Sequence[str], tracked: Sequence[str],
         as_of: _dt.date, hash_col: str = HASH) -> DataFrame:
    """Changed keys of a snapshot dated before their open version began (`apply` leaves them)."""
    _, changed = detect(target.filter(F.col(START) > F.lit(as_of)), source, keys, tracked, hash_col)
    return changed.select(*keys, "old_h", "new_h")


def overlaps(versions: DataFrame, keys: Sequence[str], start: str = START, end: str = END,
             version: str = VERSION) -> DataFrame:
    """Versions whose interval runs into the next version of the same key (grain guard).

    Keys numbered without gap or repeat pair each version with its successor by an equi-join
    on (key, version + 1), whose key is unique per row, so a key with millions of versions is
    no hot partition. Keys with gaps or repeated numbers are told by a partial aggregate and
    compared with the next by (start, version). A version overlaps when it is open-ended or
    ends after its successor starts.
    """
    keys = list(keys)
    v = F.col(version)
    shape = versions.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min(v).alias("__lo"),
                                        F.max(v).alias("__hi"), F.count_distinct(v).alias("__d"))
    odd = shape.filter(~F.coalesce((F.col("__hi") - F.col("__lo") + 1 == F.col("__n"))
                                   & (F.col("__d") == F.col("__n")), F.lit(False))).select(*keys)
    runs_into = lambda nxt: F.col(end).isNull() | (F.col(end) > F.col(nxt))

    even = join_null_safe(versions, odd, keys, "left_anti")
    nxt = even.select(*[F.col(k).alias(f"__n_{k}") for k in keys],
                      (v - 1).alias("__n_prev"), F.col(start).alias("__n_start"))
    cond = [F.col(k).eqNullSafe(F.col(f"__n_{k}")) for k in keys] + [v == F.col("__n_prev")]
    regular = even.join(nxt, cond, "inner").filter(runs_into("__n_start")).select(*versions.columns)

    w = Window.partitionBy(*keys).orderBy(F.col(start), v)
    irregular = (join_null_safe(versions, odd, keys, "left_semi")
                 .withColumns({"__next": F.lead(start).over(w), "__more": F.lead(F.lit(True)).over(w)})
                 .filter(F.col("__more") & runs_into("__next")).select(*versions.columns))
    return regular.unionByName(irregular)
