"""Substring dedup (operator 3): words covered by 50 words that an earlier document also has.

Seed and extend: documents are joined on winnowed anchors of 15 words; a shared anchor is
extended both ways to the hull of all windows around it (one comparison settles an occurrence
whose surroundings an earlier document has too), and where the surroundings differ, window by
window. Covering windows merge into maximal repeats of at least 50 words (`repeats.py`).
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import word_names
from .repeats import Repeats, apply_repeats


def _words(text: bytes) -> np.ndarray:
    return word_names(text.split())      # bytes.split() cuts at 0x20 and 0x09-0x0D only


def spec(length: int = 50, seed: int | None = None) -> Repeats:
    seed = seed or max(1, length * 3 // 10)
    run = length - seed + 1
    return Repeats(length, seed, (6, 1) if run > 6 else (1,), _words, earlier=True)


def kept_words(words: list[bytes], spans) -> list[bytes]:
    out, at = [], 0
    for a, b in spans:
        out += words[at:a]
        at = b
    return out + words[at:]


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def remove_repeated_words(docs: DataFrame, length: int = 50, keep: list[str] | None = None) -> DataFrame:
    """Every row of `docs` (columns `keep`, by default doc_id) with `kept_text` (kept words joined by
    one space) and `spans` (maximal removed runs of words). A word goes if a window of `length`
    words over it also starts in a document with a smaller doc_id; windows are judged on the input.

    Null texts have no words; a null doc_id counts as the smallest; rows with equal doc_id do not
    count against each other; documents under `length` words stay whole."""
    def project(text, spans):
        left = b" ".join(kept_words(text.split(), spans)).decode("utf-8", "replace")
        return left, [{"start": a, "end": b} for a, b in spans]

    fields = [T.StructField("kept_text", T.StringType()), T.StructField("spans", _SPANS)]
    return apply_repeats(docs, spec(length), project, fields, keep or ["doc_id"])


def repeated_words_digest(docs: DataFrame, length: int = 50) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of the same removal."""
    def project(text, spans):
        words = text.split()
        return (len(words), sum(b - a for a, b in spans),
                hashlib.sha256(b" ".join(kept_words(words, spans))).hexdigest())

    fields = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
              T.StructField("kept_sha256", T.StringType())]
    return apply_repeats(docs, spec(length), project, fields, ["doc_id"])
