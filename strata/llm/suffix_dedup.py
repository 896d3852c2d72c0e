"""Suffix-array dedup (operator 4): bytes covered by a 400-byte string that occurs twice.

Not by prefix doubling: all that is asked of a position is whether its 400 bytes are unique, so
this runs operator 3's engine on bytes. Winnowed 80-byte anchors are grouped by hash; those met
again are grouped by the hashes of 383 and then of 400 bytes. After each round a position
that is unique is discarded and one whose whole surroundings repeat is settled (`repeats.py`
has the rounds). Exact up to a collision of two 64-bit names.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import U64, mixed
from .repeats import Repeats, apply_repeats

_BYTE = mixed(np.arange(1, 257, dtype=U64) * U64(0xA24BAED4963EE407))


def _bytes(text: bytes) -> np.ndarray:
    return _BYTE[np.frombuffer(text, dtype=np.uint8)]


def spec(length: int = 400, seed: int | None = None) -> Repeats:
    seed = seed or max(1, length // 5)
    run = length - seed + 1
    return Repeats(length, seed, (18, 1) if run > 18 else (1,), _bytes, earlier=False)


def without(text: bytes, spans) -> bytes:
    """`text` less the [start, end) byte spans."""
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
    out.append(text[at:])
    return b"".join(out)


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def remove_repeated_bytes(docs: DataFrame, length: int = 400, keep: list[str] | None = None) -> DataFrame:
    """Every row of `docs` (columns `keep`, by default doc_id) with `kept_text` (the text less each
    byte covered by a `length`-byte string that also starts anywhere else; half a code point left
    at a cut is dropped), `n_kept_chars` and `spans` (removed byte runs).

    Null texts give an empty text; shorter texts than `length` are left whole; rows with equal id
    and text are one document (they do not repeat each other); an empty table gives no rows."""
    def project(text, spans):
        left = without(text, spans).decode("utf-8", "ignore")
        return left, len(left), [{"start": a, "end": b} for a, b in spans]

    fields = [T.StructField("kept_text", T.StringType()), T.StructField("n_kept_chars", T.LongType()),
              T.StructField("spans", _SPANS)]
    return apply_repeats(docs, spec(length), project, fields, keep or ["doc_id"])


def repeated_bytes_digest(docs: DataFrame, length: int = 400) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of the same removal (bytes, not decoded)."""
    def project(text, spans):
        return (len(text), sum(b - a for a, b in spans), len(spans),
                hashlib.sha256(without(text, spans)).hexdigest())

    fields = [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
    return apply_repeats(docs, spec(length), project, [*fields, T.StructField("kept_sha256", T.StringType())],
                         ["doc_id"])
