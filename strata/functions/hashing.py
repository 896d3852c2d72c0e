"""Deterministic hashes built from JVM-side expressions (codegen, no Python)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the row-hash encoding: NULL token and field separator.
NULL_TOKEN = "~"
SEPARATOR = "||"
ESCAPE = "\\"


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _escaped(c: Column, sep: str) -> Column:
    """Escape the escape char, then every separator / NULL-token char, inside a value.

    Without this, ('a|', 'b') and ('a', '|b') or a real '~' and NULL hash alike.
    """
    s = F.replace(c.cast("string"), F.lit(ESCAPE), F.lit(ESCAPE + ESCAPE))
    for ch in dict.fromkeys(sep + NULL_TOKEN):
        s = F.replace(s, F.lit(ch), F.lit(ESCAPE + ch))
    return s


def row_hash(cols: Sequence[str | Column], sep: str = SEPARATOR, escape: bool = True) -> Column:
    """SHA-256 hex of the tracked columns; NULL-aware and position-aware.

    Every column is coalesced to a NULL token, so moving a NULL between columns
    changes the hash (unlike a bare `concat_ws`, which skips NULLs).
    """
    parts = []
    for c in cols:
        v = _as_col(c)
        s = _escaped(v, sep) if escape else v.cast("string")
        parts.append(F.coalesce(s, F.lit(NULL_TOKEN)))
    return F.sha2(F.concat_ws(sep, *parts), 256)


def stable_id(*parts: str | Column, sep: str = "|") -> Column:
    """Deterministic identifier (replaces per-run `uuid()`): same row, same id on re-run. NULL and
    position count, as in `row_hash`."""
    return row_hash(parts, sep=sep)


def hash_bucket(n: int, *cols: str | Column, salt: str = "") -> Column:
    """Stable bucket in [0, n): replaces unseeded `rand()` draws and salts hot keys."""
    return F.pmod(F.xxhash64(F.lit(salt), *[_as_col(c) for c in cols]), F.lit(n)).cast("int")
