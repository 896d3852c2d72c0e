"""Operator 6: exact scores and order, recall against brute force."""
import numpy as np
import pytest

from strata.llm.ann import nearest

SCHEMA = "vec_id long, embedding array<float>, id int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0)
                                  for i, v in vectors], SCHEMA)


def brute(vectors, queries, k):
    out = {}
    x = {i: np.asarray(v, dtype=np.float32).astype(np.float64) for i, v in vectors}
    for q in queries:
        s = sorted(((-(x[q] * v).sum(), i) for i, v in x.items() if i != q))[:k]
        out[q] = [(i, -d) for d, i in s]
    return out


@pytest.mark.parametrize("scale", [False, True])
def test_recall(spark, scale):
    r = np.random.default_rng(1)
    x = r.standard_normal((3000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if scale:
        x *= r.uniform(0.5, 2, (3000, 1))
    vectors = [(i, v) for i, v in enumerate(x)]
    df = frame(spark, vectors).repartition(3)
    got = {}
    for row in nearest(df, df.where("vec_id % 60 = 0"), k=10).orderBy("query_id", "rank").collect():
        got.setdefault(row.query_id, []).append((row.vec_id, row.score))
    want = brute(vectors, range(0, 3000, 60), 10)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in w}) / 10 for q, w in want.items()]
    assert np.mean(hits) >= 0.9
    for found in got.values():
        assert len(found) == 10
    exact = {q: dict(w) for q, w in want.items()}
    assert all(s == pytest.approx(exact[q][i], abs=1e-12) for q, f in got.items() for i, s in f if i in exact[q])


def test_ties_copies_and_unusable_vectors(spark):
    e = [1.0, 0.0, 0.0]
    vectors = [(i, e) for i in range(50)] + [(100, [0.0, 1.0, 0.0]), (101, None), (102, [0.0, 0.0, 0.0]),
                                             (103, [None, 1.0, 0.0]), (104, [float("nan"), 1.0, 0.0]), (105, [1.0]),
                                             (106, [float("inf"), 0.0, 0.0]), (0, e)]
    df = frame(spark, vectors)
    got = nearest(df, df.where("vec_id in (0, 100, 101, 105)"), k=3).orderBy("query_id", "rank").collect()
    assert [(g.query_id, g.rank, g.vec_id, g.score) for g in got if g.query_id == 0] == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 3, 1.0)]
    assert {g.query_id for g in got} <= {0, 100}
    assert nearest(df.where("false"), df, k=3).collect() == []


def test_recall_outside_a_hot_group(spark):
    """A third of the rows in one tight group; the neighbours of the others are far looser."""
    r = np.random.default_rng(5)
    n, dim, k = 12_000, 48, 10
    topics = r.standard_normal((300, dim))
    x = topics[r.integers(0, 300, n)] + 1.2 * r.standard_normal((n, dim))
    hot = np.arange(n) % 3 == 0
    x[hot] = r.standard_normal(dim) + 0.1 * r.standard_normal((int(hot.sum()), dim))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    df = frame(spark, list(enumerate(x.tolist()))).repartition(4)
    got = {}
    for row in nearest(df, df.where("vec_id % 80 = 1 or vec_id % 400 = 0"), k=k).collect():
        got.setdefault(row.query_id, set()).add(row.vec_id)
    x = x.astype(np.float64)
    recall = {True: [], False: []}
    for q in (i for i in range(n) if i % 80 == 1 or i % 400 == 0):
        s = x @ x[q]
        s[q] = -np.inf
        recall[bool(hot[q])].append(len(got.get(q, set()) & set(np.argsort(-s)[:k].tolist())) / k)
    print("recall outside", np.mean(recall[False]), "inside", np.mean(recall[True]))
    assert np.mean(recall[False]) >= 0.9 and np.mean(recall[True]) >= 0.9
