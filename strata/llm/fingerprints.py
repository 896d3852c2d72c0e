"""Document fingerprints (operator 5): MinHash signatures over word shingles.

A signature holds, for each of `permutations` universal hash functions, the smallest value over
a document's 5-word shingles (in vectorised numpy), kept as 16 bits each. Two signatures agree
in a share of places that estimates the Jaccard similarity. `similar.similar` joins signature bands
in Spark and verifies Jaccard on the full sets.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, U64, chunks, mixed, stored, word_names

SHINGLE = 5
PERMUTATIONS = 64
_rng = np.random.default_rng(20240607)
_A = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * U64(2) + U64(1)
_B = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)


def shingle_names(names: np.ndarray, k: int) -> np.ndarray:
    """64-bit names of the k-word shingles of one document (fewer words: the whole as one)."""
    n = len(names)
    if n == 0:
        return names
    at = np.arange(max(1, n - k + 1))
    return Rolling(names).name(at, np.minimum(at + k, n))


def signatures(texts: list[bytes]) -> np.ndarray:
    """One row of 16-bit values per text; all ones for a text without words."""
    return set_signatures([shingle_names(word_names(t.lower().split()), SHINGLE) for t in texts])


def set_signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 16-bit values per set of shingle names (repeats do no harm); all ones if empty."""
    out = np.full((len(sets), PERMUTATIONS), 0xFFFF, dtype=np.uint16)
    full = np.array([i for i, s in enumerate(sets) if len(s)], dtype=np.int64)
    if not len(full):
        return out
    sets = [sets[i] for i in full]
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    low = np.concatenate(sets) >> U64(32)           # multiply-add-shift takes 32-bit values
    buf = np.empty_like(low)
    for p in range(PERMUTATIONS):
        np.multiply(low, _A[p], out=buf)
        np.add(buf, _B[p], out=buf)
        least = np.minimum.reduceat(buf, starts) >> U64(32)     # the shift keeps the order
        out[full, p] = (mixed(least + (U64(p) << U64(32))) & U64(0xFFFF)).astype(np.uint16)
    return out


def hexed(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=-1)


def fingerprint(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col`, `fingerprint` (hex) of every row. A null text counts as empty; equal texts have
    equal fingerprints; other columns are not read."""
    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i, j in chunks([len(t) for t in texts], 1_000_000):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(map(hexed, signatures(texts[i:j])), pa.string())],
                    names=[id_col, "fingerprint"])
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return df.select(F.col(id_col).cast("long").alias(id_col), text.alias("text")).mapInArrow(
        run, f"{id_col} long, fingerprint string")


# --- a document against its edited text and the next document -------------------------------

_EDITED = ("d long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double, part int, first_text string, last_text string")


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the next document."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


def _compare(ids, texts: list[str], following: list[str], part, first=None, last=None) -> pa.RecordBatch:
    new = [edited(a, b) for a, b in zip(texts, following)]
    blobs = [t.encode() for t in texts]
    new_blobs = [t.encode() for t in new]
    if following[:-1] == texts[1:] and texts:       # neighbours: each text is read once
        sig = signatures([*blobs, following[-1].encode()])
        own, after = sig[:-1], sig[1:]
    else:
        own, after = signatures(blobs), signatures([t.encode() for t in following])
    changed = signatures(new_blobs)
    n = len(texts)
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(b).hexdigest() for b in new_blobs], pa.string()),
        pa.array([hexed(s) for s in own], pa.string()), pa.array([hexed(s) for s in changed], pa.string()),
        pa.array(likeness(own, changed)), pa.array(likeness(own, after)),
        pa.array([part] * n, pa.int32()), pa.array([first if i == 0 else None for i in range(n)], pa.string()),
        pa.array([last if i == n - 1 else None for i in range(n)], pa.string())],
        names=[c.split()[0] for c in _EDITED.split(", ")])


def _neighbours(batches):
    """Rows in doc_id order; the last of the task waits for the first of the next task."""
    part, held, opened = TaskContext.get().partitionId(), None, False
    for batch in batches:
        all_ids, all_texts = batch.column("d").to_pylist(), batch.column("text").to_pylist()
        for i, j in chunks([len(t) for t in all_texts], 500_000):
            ids, texts = all_ids[i:j], all_texts[i:j]
            if held is not None:
                ids, texts = [held[0], *ids], [held[1], *texts]
            held = (ids[-1], texts[-1])
            if len(ids) > 1:
                yield _compare(ids[:-1], texts[:-1], texts[1:], part, first=None if opened else texts[0])
                opened = True
    if held is not None:
        yield _compare([held[0]], [held[1]], [""], part, first=None if opened else held[1], last=held[1])


def compare_with_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the next row by (doc_id, hash of the text), nulls first; after the last
    comes the first. Whole texts move once, to range partitions; only the last row of each task is
    joined with the first of the next. Null texts are empty; an empty table gives no rows."""
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = df.select(F.col(id_col).cast("long").alias("d"), text.alias("text"), F.xxhash64(text).alias("t"))
    rows = stored(src.repartitionByRange("d").sortWithinPartitions("d", "t").select("d", "text")
                  .mapInArrow(_neighbours, _EDITED), "fingerprint-rows")
    firsts = rows.where("first_text is not null").select("part", "first_text")
    parts = sorted(r.part for r in firsts.select("part").collect())      # a number per task
    follows = spark.createDataFrame(
        [(p, parts[(i + 1) % len(parts)]) for i, p in enumerate(parts)], "part int, next_part int")

    def close(batches):
        for batch in batches:
            ids, texts, nexts = (batch.column(c).to_pylist() for c in ("d", "last_text", "first_text"))
            for i in range(len(ids)):
                yield _compare([ids[i]], [texts[i]], [nexts[i]], 0)

    last = (rows.where("last_text is not null").select("d", "part", "last_text").join(follows, "part")
            .join(firsts.withColumnRenamed("part", "next_part"), "next_part").select("d", "last_text", "first_text"))
    every = rows.where("last_text is null").unionByName(last.mapInArrow(close, _EDITED))
    return every.select(F.col("d").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                        "near_edited", "near_next")
