"""Joins on keys that may be NULL: a NULL key is a key like any other (one group)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on `keys` with NULL = NULL; each key comes out once, non-key columns of the
    two sides must differ."""
    other = [f"__rk_{i}" for i in range(len(keys))]
    r = right.withColumnsRenamed(dict(zip(keys, other)))
    cond = [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, other)]
    j = left.join(r, cond, how)
    if how in ("left_anti", "left_semi"):
        return j
    rest = [c for c in j.columns if c not in keys and c not in other]
    return j.select(*[F.coalesce(k, o).alias(k) for k, o in zip(keys, other)], *rest)
