"""Change events derived from two states of a table.

The difference of two states is one full outer join on the key; rows that are equal in all
tracked columns (NULL = NULL) leave right after it. `changes.apply_changes` turns the events
and the first state back into the second.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .changes import DELETE, INSERT, UPDATE
from .joins import join_null_safe

CHANGED = "changed_columns"


def snapshot_changes(before: DataFrame, after: DataFrame, keys: Sequence[str],
                     tracked: Sequence[str] | None = None, stamp: Mapping[str, Column] | None = None,
                     deleted_col: str | None = None, op: str = "op") -> DataFrame:
    """INSERT / UPDATE / DELETE events that lead from `before` to `after`.

    * keys must be unique in each state (a NULL key is a key); `tracked` defaults to the columns
      both states have besides the keys. A column that only one state has takes no part.
    * An event holds the key, the tracked values (the new ones; of a DELETE the last ones), `op`
      and `changed_columns`: the names that differ, NULL for INSERT and DELETE.
    * `stamp` adds columns such as the order columns `ts` and `lsn` of `apply_changes`.
    * `deleted_col`: rows so flagged count as absent, so a revived row is an INSERT and a fresh
      tombstone a DELETE.

    Values are compared themselves, not by a hash, so no change is lost to a collision.
    """
    keys = list(keys)
    if tracked is None:
        tracked = [c for c in after.columns if c in before.columns and c not in [*keys, deleted_col]]
    tracked = list(tracked)

    def side(df: DataFrame, mark: str) -> DataFrame:
        if deleted_col and deleted_col in df.columns:
            df = df.where(~F.coalesce(F.col(deleted_col), F.lit(False)))
        return df.select(*keys, *[F.col(c).alias(f"{mark}{c}") for c in tracked], F.lit(True).alias(mark))

    j = join_null_safe(side(before, "__b"), side(after, "__a"), keys, "full_outer")
    had, has = F.col("__b").isNotNull(), F.col("__a").isNotNull()
    differs = [~F.col(f"__b{c}").eqNullSafe(F.col(f"__a{c}")) for c in tracked]
    names = F.filter(F.array(*[F.when(d, F.lit(c)) for c, d in zip(tracked, differs)]).cast("array<string>"),
                     lambda x: x.isNotNull())
    same = F.lit(True)
    for d in differs:
        same = same & ~d
    return j.where(~(had & has & same)).select(
        *keys, *[F.when(has, F.col(f"__a{c}")).otherwise(F.col(f"__b{c}")).alias(c) for c in tracked],
        F.when(~had, INSERT).when(~has, DELETE).otherwise(UPDATE).alias(op),
        F.when(had & has, names).alias(CHANGED),
        *[v.alias(n) for n, v in (stamp or {}).items()])
