"""Near copies by fingerprint (operator 5, beside the digests): signature bands, verified.

The 64 places of a signature make 21 bands of 3. A pair at Jaccard 0.8 shares none with probability
(1 - 0.8^3)^21, below one in a million. Equal sets are one class first; candidates are verified on
full shingle sets, each bucket from its pivot and never pair by pair (`links.py`).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, chunks, mixed, signed, stored
from .fingerprints import SHINGLE, set_signatures
from .links import DIRECT, link
from .near_dedup import class_members, set_sums, shingle_set

BANDS, ROWS = 21, 3


def signature_bands(signature: np.ndarray) -> np.ndarray:
    """One 64-bit name per band of each signature; it includes the band's number."""
    n = len(signature)
    parts = signature[:, :BANDS * ROWS].astype(U64).reshape(n, BANDS, ROWS)
    name = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U64), (n, BANDS))
    for r in range(ROWS):
        name = (name << U64(16)) | parts[:, :, r]
    return mixed(name)


def _banded(batches):
    of = shingle_set(SHINGLE)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for i, j in chunks([len(t) for t in texts], 1_000_000):
            sets = [of(t) for t in texts[i:j]]
            names = signed(np.ascontiguousarray(signature_bands(set_signatures(sets))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("d").slice(i, j - i), *set_sums(sets),
                 pa.array([row if len(s) else [] for s, row in zip(sets, names)], pa.list_(pa.int64()))],
                names=["d", "n", "s1", "s2", "bands"])


def similar(df: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
            direct: int = DIRECT) -> DataFrame:
    """(a, b), a < b: verified links between ids whose sets of 5-word shingles reach `percent` percent
    of their union. Members of a class of equal sets are linked with its smallest id, and a
    pair inside a component that other links already join may be left out, so that a group
    costs rows in proportion to its members: the components are those of all similar pairs.
    Null ids and texts without words take no part."""
    src = df.select(F.col(id_col).cast("long").alias("d"),
                    F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    made = stored(src.where("d is not null").mapInArrow(_banded, "d long, n long, s1 long, s2 long, bands array<long>"),
                  "similar-bands")
    member, heads = class_members(made.where("n > 0"))
    texts = src.where("d is not null").select(F.col("d").alias("v"), "text")
    links, _ = link(heads, texts, shingle_set(SHINGLE), percent, direct=direct)
    return member.select("a", "b").unionByName(links).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
