"""MinHash near-dedup (operator 2) by fast similarity sketching.

A sketch has `SIZE` coordinates. Round i hashes every shingle to a bin and keeps the smallest
value; SIZE rounds use fresh random bins, and should bins still be empty, SIZE more rounds fill
them one by one with all shingles, so every coordinate is filled. Values carry their round, so
earlier rounds win; a coordinate agrees with probability equal to the Jaccard similarity and
the share of equal coordinates is concentrated around it. Long documents are done after one or
two rounds, whatever the number of coordinates.

48 bands of 6 coordinates meet: a pair at 0.8 shares none with probability (1 - 0.8^6)^48, under
one in a million. Equal sets are one class before banding; candidates are verified on full
sets and linked without expanding groups (`links.py`).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MASK64, U64, chunks, mixed, signed, stored, word_names
from .fingerprints import shingle_names
from .graph import joined as merged
from .links import DIRECT, link

BANDS, ROWS = 48, 6
SIZE = BANDS * ROWS


def shingle_set(words: int):
    """text bytes -> sorted distinct 64-bit names of its `words`-word shingles, A-Z lower-cased."""
    def of(text: bytes) -> np.ndarray:
        s = np.sort(shingle_names(word_names(text.lower().split()), words))
        return s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s
    return of


def set_sums(sets: list[np.ndarray]) -> list[pa.Array]:
    """Size and two 64-bit sums of each set; equal sets are those with all three equal."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    full = np.flatnonzero(size)
    sums = np.zeros((2, len(sets)), dtype=U64)
    if len(full):
        items = np.concatenate([sets[i] for i in full])
        starts = np.cumsum(size[full]) - size[full]
        for row, x in zip(sums, (items, ~items)):
            row[full] = np.add.reduceat(mixed(x), starts)
    return [pa.array(size), *(pa.array(signed(row)) for row in sums)]


def sketches(sets: list[np.ndarray], size: int = SIZE) -> np.ndarray:
    """Fast similarity sketches of non-empty sets, a row of `size` values each."""
    n = len(sets)
    out = np.full(n * size, ~U64(0))
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    items = np.concatenate(sets) if sets else np.empty(0, U64)
    empty = np.full(n, size)
    for r in range(2 * size):
        if not len(items):
            break
        h = mixed(items + U64((r + 1) * 0x9E3779B97F4A7C15 & MASK64))
        if r < size:
            cell = owner * size + ((h >> U64(32)) * U64(size) >> U64(32)).astype(np.int64)
        else:
            cell = owner * size + (r - size)
        value = (h & U64(0xFFFFFFFF)) | (U64(r) << U64(32))
        np.minimum.at(out, cell, value)
        empty = (out.reshape(n, size) == ~U64(0)).sum(axis=1) if r % 4 == 0 or n < 64 else empty
        if r % 4 == 0 or n < 64:
            live = empty[owner] > 0
            items, owner = items[live], owner[live]
    return out.reshape(n, size)


def band_names(sketch: np.ndarray) -> np.ndarray:
    """One 64-bit name per band of each sketch; it includes the band's number."""
    n = len(sketch)
    parts = sketch.reshape(n, BANDS, ROWS)
    name = np.broadcast_to(mixed(np.arange(1, BANDS + 1, dtype=U64)), (n, BANDS))
    for r in range(ROWS):
        name = mixed(name * U64(0x9FB21C651E98DF25) + parts[:, :, r])
    return name


def _sketch_rows(words: int):
    of = shingle_set(words)
    schema = pa.schema([("d", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()),
                        ("bands", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, j in chunks([len(t) for t in texts], 1_000_000):
                sets = [of(t) for t in texts[i:j]]
                full = [k for k, s in enumerate(sets) if len(s)]
                names = signed(np.ascontiguousarray(band_names(sketches([sets[k] for k in full])))) if full else []
                bands = [[] for _ in sets]
                for k, row in zip(full, names):
                    bands[k] = row
                yield pa.RecordBatch.from_arrays(
                    [batch.column("d").slice(i, j - i), *set_sums(sets), pa.array(bands, pa.list_(pa.int64()))],
                    schema=schema)
    return run


def class_members(real: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links (a, b) of a class of equal sets from its smallest id, bands (v, band) left to join,
    which may repeat) of rows (d, n, s1, s2, bands)."""
    classes = real.groupBy("s1", "s2", "n").agg(F.min("d").alias("rep"), F.max("d").alias("top"))
    member = (real.select("d", "s1", "s2", "n").distinct()
              .join(classes.where("rep <> top").select("s1", "s2", "n", "rep"), ["s1", "s2", "n"])
              .where("d <> rep").select(F.col("rep").alias("a"), F.col("d").alias("b"), "s1", "s2", "n"))
    member = stored(member, "near-classes")
    # an id with another text keeps that text's bands
    heads = (real.join(member.select(F.col("b").alias("d"), "s1", "s2", "n"), ["d", "s1", "s2", "n"], "left_anti")
             .select(F.col("d").alias("v"), F.explode("bands").alias("band")))
    return member.select("a", "b").distinct(), heads


def near_duplicates(df: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text", direct: int = DIRECT) -> DataFrame:
    """`id_col`, n_shingles, component_id (smallest id reachable over links), kept, of every row.

    Two documents are linked if their sets of `words`-word shingles reach `percent` percent of
    their union; a text of fewer words is one shingle; texts without words have an empty set
    and no links. Rows that share an id are one document, linked to itself. Rows with a null id
    take no part: their component_id is null and they are kept."""
    src = df.select(F.col(id_col).cast("long").alias("d"),
                    F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    made = stored(src.mapInArrow(_sketch_rows(words), "d long, n long, s1 long, s2 long, bands array<long>"),
                  "near-sketches")
    real = made.where("n > 0 and d is not null")
    member, heads = class_members(real)
    texts = src.where("d is not null").select(F.col("d").alias("v"), "text")
    _, comp = link(heads, texts, shingle_set(words), percent, direct=direct)
    # an id joins the component of its class's representative
    joined = (member.join(comp.select(F.col("v").alias("a"), "component"), "a", "left")
              .select(F.col("b").alias("v"), F.coalesce("component", "a").alias("component")))
    label = comp.unionByName(joined)
    kind = F.struct("s1", "s2", "n")
    if real.groupBy("d").agg(F.min(kind).alias("lo"), F.max(kind).alias("hi")).where("lo <> hi").limit(1).count():
        # an id with several texts joins the classes and bands of all of them
        ends = (member.select(F.explode(F.array("a", "b")).alias("v")).distinct().join(comp.select("v"), "v", "left_anti")
                .select("v", F.col("v").alias("component")))
        label = merged(comp.unionByName(ends), member, "near-merged")
    return (made.select("d", "n").join(label.select(F.col("v").alias("d"), "component"), "d", "left")
            .select(F.col("d").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("d").isNotNull(), F.coalesce("component", "d")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("component_id") == F.col(id_col), F.lit(True))))
