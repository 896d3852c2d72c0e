"""Ranked lexical search (operator 11): bag deduplication.

A score sees of a document only how often it holds the items' terms and its length measure m. So
documents are restricted to the items' vocabulary; those with the same term frequencies and the
same m form a class: grouped by a hash and the bag itself, so equal hashes alone never join
two. Each class is scored once against all items; the winning classes' members then take
the ranks by ascending document id.

Items are taken in blocks of bounded text, so the vocabulary a task holds is bounded whatever the
number of items; every block meets all documents.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, stored

#: Fixed values of the score.
SATURATION, FULL_LENGTH, LENGTH_SHARE, SHIFT, WEIGHT = 8, 100, 75, 10 ** 9, 1000
#: Items a block holds at most, by bytes of text and by terms times items (a longer item is a block
#: of its own): the vocabulary and the items' table of a task stay below some 64 MB.
BLOCK_BYTES, BLOCK_CELLS = 4_000_000, 8_000_000
#: Below this, sums of whole numbers are exact in floating point too.
EXACT = 2.0 ** 53

#: A-Z become a-z, the other ASCII characters that no term holds a space; the rest stays.
_FOLD = bytes(c if c > 127 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased."""
    return text.translate(_FOLD).split()


@dataclass(frozen=True)
class Items:
    """One block of items: their vocabulary, and of each item its terms with their repeats."""

    ids: list[int]
    vocabulary: dict[bytes, int]
    wanted: list[tuple[np.ndarray, np.ndarray]]     # term numbers, repeats

    @staticmethod
    def of(rows: list[tuple[int, bytes]]) -> Items:
        vocabulary: dict[bytes, int] = {}
        wanted = []
        for _, text in rows:
            numbers = [vocabulary.setdefault(t, len(vocabulary)) for t in terms(text)]
            wanted.append(tuple(np.unique(np.array(numbers, dtype=np.int64), return_counts=True)))
        return Items([i for i, _ in rows], vocabulary, wanted)


def _bags(items: Items):
    """(d, n, bag) of every document with a term: n all its terms, bag the vocabulary's term numbers
    (rising) and their frequencies as 32-bit numbers, frequencies after the numbers."""
    def run(batches):
        number, size = items.vocabulary.get, max(1, len(items.vocabulary))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, j in chunks([len(t) for t in texts], 4_000_000):
                ns, bags = [], []
                for words in map(terms, texts[i:j]):
                    ns.append(len(words))
                    found = np.fromiter((x for x in map(number, words) if x is not None), dtype=np.int64)
                    if len(found) * 4 > size:
                        tf = np.bincount(found)
                        at = np.flatnonzero(tf)
                        tf = tf[at]
                    else:
                        at, tf = np.unique(found, return_counts=True)
                    bags.append(np.concatenate([at, tf]).astype("<u4").tobytes())
                out = pa.RecordBatch.from_arrays([batch.column("d").slice(i, j - i), pa.array(ns, pa.int64()),
                                                  pa.array(bags, pa.binary())], names=["d", "n", "bag"])
                yield out.filter(pa.array([n > 0 for n in ns], pa.bool_()))
    return run


def _unpacked(bags: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term number, frequency) of every entry of the bags."""
    halves = [np.frombuffer(b, dtype="<u4").reshape(2, -1) for b in bags]
    row = np.repeat(np.arange(len(bags)), [h.shape[1] for h in halves])
    both = np.concatenate(halves, axis=1).astype(np.int64)
    return row, both[0], both[1]


def _frequencies(size: int):
    """(term, documents): of a task's classes, each counted with its members."""
    def run(batches):
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            members = batch.column("members").to_numpy()
            row, term, _ = _unpacked(batch.column("bag").to_pylist())
            np.add.at(total, term, members[row])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": some, "documents": total[some]})
    return run


def _best(items: Items, weight: np.ndarray, top: int):
    """(item, score, class, first): of every task the `top` classes of each item, by falling score and
    rising smallest member (null last). No more of a task's classes can hold one of the item's
    `top` documents, since their smallest members alone outrank all others."""
    def run(batches):
        size = len(weight)
        longest = max((int(c.sum()) for _, c in items.wanted), default=0)
        exact = float(weight.max(initial=0)) * (SHIFT // WEIGHT) * longest < EXACT
        want = np.zeros((size, len(items.ids)), dtype=np.float64 if exact else np.int64)
        for k, (t, c) in enumerate(items.wanted):
            want[t, k] = c
        best: list[list[tuple]] = [[] for _ in items.ids]       # (-score, first, class)
        step = max(1, 32_000_000 // (8 * max(1, size)))
        for batch in batches:
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                row, term, tf = _unpacked(part.column("bag").to_pylist())
                m = part.column("m").to_numpy()[row]
                gain = weight[term] * ((SHIFT * tf) // (WEIGHT * tf + SATURATION * m))
                table = np.zeros((part.num_rows, size), dtype=want.dtype)
                table[row, term] = gain
                score = (table @ want).astype(np.int64)
                none = pa.array([2 ** 63 - 1], pa.int64())[0]
                first = part.column("first").fill_null(none).to_numpy()
                number = part.column("class").to_pylist()
                for k in range(len(items.ids)):
                    s = score[:, k]
                    at = np.flatnonzero(s > 0)
                    if len(at) > top:               # ties with the last place stay for the sort
                        at = at[s[at] >= np.partition(s[at], len(at) - top)[len(at) - top]]
                    if len(best[k]) == top:
                        at = at[s[at] >= -best[k][-1][0]]
                    if len(at):
                        at = at[np.lexsort((first[at], -s[at]))[:top]]
                        best[k] = sorted([*best[k], *((-int(s[x]), int(first[x]), number[x]) for x in at)])[:top]
        rows = [(k, -s, f, c) for k, found in enumerate(best) for s, f, c in found]
        yield pa.RecordBatch.from_pydict({
            "item": pa.array([r[0] for r in rows], pa.int32()), "score": pa.array([r[1] for r in rows], pa.int64()),
            "first": pa.array([r[2] for r in rows], pa.int64()), "class": pa.array([r[3] for r in rows], pa.string())})
    return run


def _block(docs: DataFrame, items: Items, top: int) -> DataFrame:
    """item (number within the block), rank, d, score."""
    bags = stored(docs.mapInArrow(_bags(items), "d long, n long, bag binary"), "lexical-bags")
    n_docs, n_terms = bags.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # div as // of whole numbers; decimals, as 75 n N may leave 64 bits
    length = (F.lit(LENGTH_SHARE).cast("decimal(3,0)") * F.col("n").cast("decimal(15,0)") * F.lit(n_docs).cast("decimal(18,0)"))
    m = F.lit(FULL_LENGTH - LENGTH_SHARE) + F.expr("div(product, total)")
    named = (bags.where(F.length("bag") > 0)
             .select("d", "bag", length.alias("product"), F.lit(max(1, n_terms)).cast("decimal(18,0)").alias("total"))
             .select("d", "bag", m.cast("long").alias("m"))
             .withColumn("h", F.xxhash64("m", "bag")))
    classes = stored(named.groupBy("h", "m", "bag").agg(F.count("*").alias("members"), F.min("d").alias("first")), "lexical-classes")
    found = (classes.mapInArrow(_frequencies(len(items.vocabulary)), "term long, documents long")
             .groupBy("term").agg(F.sum("documents").alias("documents")).collect())      # a row per item term at most
    weight = np.zeros(len(items.vocabulary), dtype=np.int64)
    for term, documents in found:
        weight[term] = math.floor(WEIGHT * math.log((2 * n_docs + 2) / (2 * documents + 1)))
    # a class is named by hash, m and its bag's digest
    name = F.concat_ws(":", F.col("h"), F.col("m"), F.sha2("bag", 256))
    scored = (classes.select("bag", "m", "first", name.alias("class"))
              .mapInArrow(_best(items, weight, top), "item int, score long, first long, class string"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), "first", "class")
    winners = stored(scored.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top), "lexical-winners")
    # of each winning class its first members; no class can place more than `top`
    wanted = winners.select("class").distinct()
    members = (named.withColumn("class", name).join(wanted, "class")
               .withColumn("nth", F.row_number().over(Window.partitionBy("class").orderBy(F.col("d").asc_nulls_last())))
               .where(F.col("nth") <= top).select("class", "d"))
    ranked = Window.partitionBy("item").orderBy(F.desc("score"), F.col("d").asc_nulls_last())
    return (winners.join(members, "class").withColumn("rank", F.row_number().over(ranked).cast("int"))
            .where(F.col("rank") <= top).select("item", "rank", "d", "score"))


def search(df: DataFrame, items: DataFrame, top: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """`item_col`, rank (from 1), `id_col`, score: each item's `top` rows of `df` with a score above 0,
    equal scores by ascending id (null last).

    Null and empty texts have no terms: as documents they don't count, as items they find nothing.
    Every row of `df` is a document of its own, repeated rows and ids too; every row of `items` is
    an item. An empty table on either side gives no rows; other columns are not read."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary")
    docs = df.select(F.col(id_col).cast("long").alias("d"), text(text_col).alias("text"))

    def ranked(block):
        found = _block(docs, Items.of(block), top)
        names = F.array(*[F.lit(i).cast("long") for i, _ in block])
        return found.select(F.element_at(names, F.col("item") + 1).alias(item_col), "rank", F.col("d").alias(id_col), "score")

    blocks, block, size, count = [], [], 0, 0
    for r in items.select(F.col(item_col).cast("long").alias("i"), text(item_text).alias("t")).orderBy("i").toLocalIterator():
        t = bytes(r["t"])
        size, count = size + len(t), count + len(terms(t))
        if block and (size > BLOCK_BYTES or count * (len(block) + 1) > BLOCK_CELLS):
            blocks.append(ranked(block))
            block, size, count = [], len(t), len(terms(t))
        block.append((r["i"], t))
    if block:
        blocks.append(ranked(block))
    if not blocks:
        return df.sparkSession.createDataFrame([], f"{item_col} long, rank int, {id_col} long, score long")
    out = blocks[0]
    for b in blocks[1:]:
        out = out.unionByName(b)
    return out
