"""Small scalar building blocks: guarded ratios, literal maps, ladders, masking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def guarded_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den when den > 0, else NULL (never a division error under ANSI)."""
    den = _as_col(den)
    return F.when(den > 0, _as_col(num) / den)


def case_map(c: str | Column, mapping: Mapping, default=None) -> Column:
    """Simple `CASE x WHEN k THEN v ... ELSE default END`."""
    c = _as_col(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default)) if default is not None else expr


def threshold_ladder(c: str | Column, steps: Sequence[tuple[float, object]], default) -> Column:
    """First `(upper, label)` with `c < upper` wins; else `default` (weighted buckets)."""
    c = _as_col(c)
    expr = None
    for upper, label in steps:
        cond = c < F.lit(upper)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def mask_prefix(c: str | Column, keep: int = 5, suffix: str = "***") -> Column:
    """Keep the first `keep` characters and append `suffix`; NULL stays NULL."""
    c = _as_col(c)
    return F.concat(F.left(c, F.lit(keep)), F.lit(suffix))


def mask_hash(c: str | Column, key: str, keep: int = 0, suffix: str = "***") -> Column:
    """Keyed-hash mask: distinct inputs stay distinct (joinable) but unreadable. The whole digest
    is kept; the key enters twice (HMAC-like nesting), so a longer text with the key's own
    prefix does not extend a known digest."""
    c = _as_col(c)
    inner = F.sha2(F.concat(F.lit(key), F.lit("|"), c.cast("string")), 256)
    h = F.sha2(F.concat(F.lit(key), F.lit("|"), inner), 256)
    return F.when(c.isNotNull(), F.concat(F.left(c, F.lit(keep)), h, F.lit(suffix)))
