"""Approximate nearest neighbours (operator 6): multiprobe p-stable hashing.

Each of several tables hashes a vector to the cells floor((a.x + b) / width) of a few Gaussian
(2-stable) projections. Largest inner product becomes nearest neighbour on the unit sphere by
the usual extra coordinate sqrt(1 - |x|^2 / max^2) for indexed vectors and 0 for queries.

A query visits its own bucket and perturbed ones in order of estimated success: a neighbour at
cosine c has projections normal around c times the query's, so a bucket's success is a product
of normal cell probabilities. It stops when a table's visited buckets hold `success` of that
probability; c is the similarity expected of the query's own k-th neighbour among n vectors,
estimated per query from a sample of at most SAMPLE rows (the only thing fitted on a sample).
The estimate is checked: the k-th similarity found is never above the true one, so a query that
found less than its c (or fewer than k) visits the buckets that this lower cosine adds.

Buckets are cut into blocks of vectors and blocks of queries, so a bucket with a third of all
rows is many small pieces of work. A block is searched by one exact matrix product in double
precision; each task keeps the k best of each query, and tables merge in one small aggregate.
"""

from __future__ import annotations

from math import ceil, erf, log, sqrt
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import spread_below, spread_key, stored

TABLES, WIDTH, SAMPLE = 6, 1.5, 2000
BLOCK, QUERY_BLOCK, BEAM = 1024, 512, 4096


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, x array<double>) of the vectors that take part: an id, no null or non-finite component,
    not all zero, and of the most frequent length."""
    v = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("x"))
    v = v.where("id is not null and x is not null and size(x) > 0 and forall(x, e -> e is not null and not isnan(e) "
                "and abs(e) < double('Infinity')) and exists(x, e -> e <> 0)")
    lengths = v.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return v.where(F.size("x") == (lengths[0].n if lengths else 0))


def matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


class Hashes:
    """The tables' projections; everything follows from (dim, bits, seed)."""

    def __init__(self, dim: int, projections: int, longest: float, success: float, seed: int = 17):
        r = np.random.default_rng(seed)
        self.m, self.longest = projections, longest
        self.a = r.standard_normal((TABLES, projections, dim + 1))
        self.b = r.random((TABLES, projections)) * WIDTH
        self.enough = 1 - (1 - success) ** (1 / TABLES)

    def project(self, x: np.ndarray, query: bool) -> np.ndarray:
        """[table, projection, row] of unit vectors."""
        norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
        if query:
            unit = np.hstack([x / norm, np.zeros_like(norm)])
        else:
            unit = np.hstack([x / self.longest, np.sqrt(np.maximum(0, 1 - (norm / self.longest) ** 2))])
        return self.a @ unit.T

    def cells(self, projected: np.ndarray) -> np.ndarray:
        return np.floor((projected + self.b[:, :, None]) / WIDTH).astype(np.int64)

    @staticmethod
    def bucket(cells: np.ndarray) -> np.ndarray:
        """A number for each column of [projection, row] cells."""
        out = np.zeros(cells.shape[1:], dtype=np.int64)
        for c in cells:
            out = out * 64 + (c + 32).clip(0, 63)
        return out

    def probes(self, projected: np.ndarray, table: int, cosine: float) -> np.ndarray:
        """Buckets one query ([projection] values) visits in a table for neighbours at `cosine` or
        more, most promising first."""
        cosine = within(cosine)
        spread = sqrt(1 - cosine ** 2)
        total, keys = np.ones(1), np.zeros(1, dtype=np.int64)
        for j in range(self.m):
            p, off = projected[j] * cosine, self.b[table, j]
            low, high = floor_cell(p - 3 * spread + off), floor_cell(p + 3 * spread + off)
            cell = np.arange(low, high + 1)
            edges = (np.arange(low, high + 2) * WIDTH - off - p) / (spread * sqrt(2))
            chance = np.diff([erf(e) for e in edges]) / 2
            total = np.outer(total, chance).ravel()
            keys = (keys[:, None] * 64 + (cell + 32).clip(0, 63)).ravel()
            if len(total) > BEAM:
                best = np.argpartition(-total, BEAM)[:BEAM]
                total, keys = total[best], keys[best]
        order = np.argsort(-total, kind="stable")
        stop = int(np.searchsorted(np.cumsum(total[order]), self.enough)) + 1
        return keys[order][:stop]


def floor_cell(x: float) -> int:
    return int(np.floor(x / WIDTH))


def within(cosine: float) -> float:
    return min(max(cosine, 0.02), 0.98)


def expected(sims: np.ndarray, k: int, share: float) -> tuple[float, float]:
    """(estimate, low estimate) of a query's k-th similarity from those to a sample that holds
    `share` of the rows: by the normal tail, and by the sample's own order, low enough that the
    sample rarely holds so many of the k nearest."""
    if not len(sims):
        return 0.0, 0.0
    held = k * share
    nth = min(len(sims), max(1, ceil(held + 2 * sqrt(held * (1 - share)) + 1 - share)))
    low = float(np.partition(sims, -nth)[-nth])
    if share >= 1:
        return low, low
    tail = NormalDist().inv_cdf(max(0.5, 1 - held / len(sims)))
    return max(low, float(sims.mean() + tail * sims.std())), low


def best_of(q: np.ndarray, v: np.ndarray, s: np.ndarray, k: int):
    """The k best distinct vectors of each query: highest score, then smallest id."""
    order = np.lexsort((v, -s, q))
    q, v, s = q[order], v[order], s[order]
    if len(q):
        same = np.concatenate([[False], (q[1:] == q[:-1]) & (v[1:] == v[:-1])])
        q, v, s = q[~same], v[~same], s[~same]
        start = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
        nth = np.arange(len(q)) - np.repeat(start, np.diff([*start, len(q)]))
        q, v, s = q[nth < k], v[nth < k], s[nth < k]
    return q, v, s


def search_block(qi, qx, vi, vx, k: int):
    """Candidates for the k best of each query within one block, with inner products in double.
    The matrix product picks (with a margin for its rounding); the scores are then summed pair by
    pair, so equal vectors get equal scores wherever they lie."""
    scores = qx @ vx.T
    scores[qi[:, None] == vi[None, :]] = -np.inf
    if scores.shape[1] > k:
        floor = np.partition(scores, -k, axis=1)[:, -k] - 1e-9 * (1 + np.abs(scores).max(initial=0, where=np.isfinite(scores)))
        rows, cols = np.nonzero((scores >= floor[:, None]) & np.isfinite(scores))
    else:
        rows, cols = np.nonzero(np.isfinite(scores))
    return best_of(qi[rows], vi[cols], np.ascontiguousarray(qx[rows] * vx[cols]).sum(axis=1), k)


def nearest(df: DataFrame, queries: DataFrame, k: int = 20, success: float = 0.96, id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), `id_col`, score: for each query (same columns as `df`) the k vectors of
    `df` with the largest inner product found, ties to the smaller id. A query never finds its own
    id; repeated ids count once. Vectors that are null, zero, or hold null or non-finite
    components take no part; nor do those of another length than most."""
    data = stored(usable(df, id_col, vec_col), "ann-vectors")
    stats = data.agg(F.count("*").alias("n"), F.max(F.expr("sqrt(aggregate(x, 0d, (s, e) -> s + e * e))")).alias("longest"),
                     F.max(F.size("x")).alias("dim")).first()
    result = f"query_id long, rank int, {id_col} long, score double"
    if not stats.n:
        return df.sparkSession.createDataFrame([], result)
    n, dim, longest = stats.n, stats.dim, stats.longest
    sample = (data.where(spread_key(F.col("id")) < spread_below(SAMPLE, n)).orderBy(spread_key(F.col("id")), "id")
              .limit(SAMPLE).toPandas())
    share = len(sample) / n
    sample = sample.drop_duplicates("id")
    sample_ids, sample_x = sample["id"].to_numpy(), np.stack(sample["x"].to_numpy()) / longest
    projections = max(1, min(10, round(log(max(n / BLOCK * 4, 2)) / log(3.5))))
    hashes = Hashes(dim, projections, longest, success)

    def index_rows(batches):
        for batch in batches:
            if batch.num_rows:
                b = np.stack([hashes.bucket(c) for c in hashes.cells(hashes.project(matrix(batch.column("x")), False))])
                for t in range(TABLES):
                    yield pa.RecordBatch.from_arrays([pa.array([t] * batch.num_rows, pa.int32()), pa.array(b[t]),
                                                      *batch.columns], names=["tab", "bucket", "id", "x"])

    def estimated(batches):
        for batch in batches:
            if batch.num_rows:
                ids, x = batch.column("id").to_numpy(), matrix(batch.column("x"))
                sims = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ sample_x.T
                c = [expected(row[sample_ids != i], k, share) for i, row in zip(ids, sims)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([within(e) for e, _ in c]), pa.array([low for _, low in c])],
                                                 names=["id", "x", "cosine", "low"])

    def probe_rows(batches):
        """The buckets that `cosine` calls for, without those that a higher one, `done`, did."""
        for batch in batches:
            if not batch.num_rows:
                continue
            p = hashes.project(matrix(batch.column("x")), True)
            cosine, done = batch.column("cosine").to_pylist(), batch.column("done").to_pylist()
            for i in range(batch.num_rows):
                each = [hashes.probes(p[t, :, i], t, cosine[i]) for t in range(TABLES)]
                if done[i] is not None:
                    each = [np.setdiff1d(e, hashes.probes(p[t, :, i], t, done[i])) for t, e in enumerate(each)]
                size = [len(e) for e in each]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.arange(TABLES, dtype=np.int32), size)), pa.array(np.concatenate(each)),
                     batch.column("id").take(pa.array([i] * sum(size), pa.int64()))], names=["tab", "bucket", "id"])

    def blocks(rows, size, fields, as_):
        """rows of a bucket in blocks of about `size`, by a hash of the id."""
        count = rows.groupBy("tab", "bucket").agg(F.ceil(F.count("*") / size).alias("parts"))
        return (rows.join(count, ["tab", "bucket"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
                .groupBy("tab", "bucket", "part").agg(F.collect_list(F.struct(*fields)).alias(as_)).drop("part"))

    asked = stored(usable(queries, id_col, vec_col).where(F.size("x") == dim).dropDuplicates(["id"])
                   .mapInArrow(estimated, "id long, x array<double>, cosine double, low double"), "ann-queries")
    index = data.mapInArrow(index_rows, "tab int, bucket long, id long, x array<double>")
    held = index.select("tab", "bucket").distinct()

    def search(batches):
        kept: list = [[], [], []]
        size = 0

        def pack():
            q, v, s = best_of(*(np.concatenate(c) for c in kept), k)
            return pa.RecordBatch.from_arrays([pa.array(q), pa.array(v), pa.array(s)], names=["q", "v", "s"])

        for batch in batches:
            for i in range(batch.num_rows):
                sides = []
                for name in ("q", "v"):
                    items = batch.column(name).slice(i, 1).flatten()
                    sides += [items.field("id").to_numpy(), matrix(items.field("x"))]
                for c, found in zip(kept, search_block(*sides, k)):
                    c.append(found)
                size += len(kept[0][-1])
                if size > 400_000:
                    best = best_of(*(np.concatenate(c) for c in kept), k)
                    kept, size = [[b] for b in best], len(best[0])
                    if size > 200_000:          # many queries in this task: pass on what there is
                        yield pack()
                        kept, size = [[], [], []], 0
        if size:
            yield pack()

    by_query = Window.partitionBy("q").orderBy(F.desc("s"), "v")

    def visited(wanted):
        """q, v, s of all candidates in the buckets that `wanted` (id, x, cosine, done) calls for."""
        probes = (wanted.mapInArrow(probe_rows, "tab int, bucket long, id long")
                  .join(held, ["tab", "bucket"], "left_semi"))
        work = (blocks(index, BLOCK, ["id", "x"], "v").join(
            blocks(probes.join(wanted.select("id", "x"), "id"), QUERY_BLOCK, ["id", "x"], "q"), ["tab", "bucket"]).select("v", "q"))
        return work.mapInArrow(search, "q long, v long, s double")

    def ranked(found):
        return (found.groupBy("q", "v").agg(F.max("s").alias("s"))
                .withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k))

    first = stored(ranked(visited(asked.withColumn("done", F.lit(None).cast("double")))), "ann-first")
    # the k-th cosine found bounds the true one from below; without k, the sample's low estimate does
    kth = first.groupBy(F.col("q").alias("id")).agg(F.count("*").alias("n"), F.min("s").alias("least"))
    norm = F.expr("sqrt(aggregate(x, 0d, (s, e) -> s + e * e))")
    reached = F.when(F.col("n") >= k, F.col("least") / norm / longest).otherwise(F.least("low", F.col("least") / norm / longest))
    again = (asked.join(kth, "id", "left").withColumn("reached", F.coalesce(reached, "low"))
             .where(F.col("reached") < F.col("cosine"))
             .select("id", "x", F.col("reached").alias("cosine"), F.col("cosine").alias("done")))
    again = stored(again, "ann-again")
    if again.limit(1).count():
        first = ranked(first.select("q", "v", "s").unionByName(visited(again)))
    return first.select(F.col("q").alias("query_id"), "rank", F.col("v").alias(id_col), F.col("s").alias("score"))
