"""Operator 2 and its link machinery against brute force."""
import random

import numpy as np
import pytest

from strata.llm.graph import components
from strata.llm.near_dedup import near_duplicates, shingle_set, sketches


def brute(docs, k, percent=80):
    sets = {}
    for d, t in docs:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    parent = {d: d for d, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def corpus(seed):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(50)] + ["É", "the", "THE"]
    docs = []
    for i in range(120):
        if docs and r.random() < 0.6:
            w = (r.choice(docs)[1] or "x").split()
            for _ in range(r.choice([0, 1, 1, 2, 5])):
                if w:
                    w[r.randrange(len(w))] = r.choice(vocab)
            t = " ".join(w)
        else:
            t = r.choice([" ", "\n"]).join(r.choice(vocab) for _ in range(r.choice([0, 1, 3, 40, 90])))
        docs.append((i * 7 - 100, t))
    docs += [(5000, None), (5001, "")]
    r.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed,k", [(1, 4), (2, 5)])
def test_matches_brute_force(spark, seed, k):
    docs = corpus(seed)
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, v int").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, words=k).collect()}
    assert got == brute(docs, k)


def copies(seed, base_there):
    """A large group of copies with edits of their own, some too many to link with the original."""
    r = random.Random(seed)
    base = [f"b{i}" for i in range(140)]
    docs = [(0, " ".join(base))] if base_there else []
    families = [[(r.randrange(140), f"f{f}{i}") for i in range(3)] for f in range(3)]
    for i in range(1, 160):
        w = list(base)
        for at, x in r.choice([[], [], families[i % 3]]):
            w[at] = x
        for _ in range(r.choice([1, 2, 2, 3, 4, 5])):
            w[r.randrange(140)] = f"e{i}{r.random()}"
        docs.append((i * 5, " ".join(w)))
    return docs


@pytest.mark.parametrize("seed,base_there,direct", [(1, True, 2), (2, False, 2), (3, False, 2), (4, False, 10_000)])
def test_large_group_of_edited_copies(spark, seed, base_there, direct):
    docs = copies(seed, base_there)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, words=4, direct=direct).collect()}
    want = brute(docs, 4)
    assert got == want
    assert len({c for _, c, _ in want.values()}) > 5


def test_edges(spark):
    schema = "doc_id long, text string"
    assert near_duplicates(spark.createDataFrame([], schema)).collect() == []
    t = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(None, t), (None, None), (9, t), (9, t), (9, "other words here"), (12, "other words here"),
                                (3, t + " more")], schema)
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in near_duplicates(df).collect())
    assert got == sorted([("None", "None", True)] * 2 + [("9", "3", False)] * 3 + [("12", "3", False), ("3", "3", True)])


def test_sketch_fills_and_estimates():
    of = shingle_set(5)
    one = of(b"alone")
    assert (sketches([one]) != np.uint64(2**64 - 1)).all()
    r = np.random.default_rng(0)
    base = r.integers(0, 2**63, 2000, dtype=np.uint64)
    other = np.concatenate([base[:1600], r.integers(0, 2**63, 400, dtype=np.uint64)])
    s = sketches([base, other])
    assert abs((s[0] == s[1]).mean() - 1600 / 2400) < 0.12


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def test_an_id_with_a_copy_and_another_text_keeps_the_links_of_both(spark):
    one = " ".join(f"one{i}" for i in range(60))
    two = " ".join(f"two{i}" for i in range(200))
    rows = [(1, one), (2, one), (2, two), (3, two + " more"), (4, " ".join(f"own{i}" for i in range(60)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.component_id) for r in near_duplicates(df, words=4, percent=80).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_an_id_that_copies_two_texts_joins_both(spark):
    one, two = (" ".join(f"{x}{i}" for i in range(40)) for x in ("one", "two"))
    rows = [(1, one), (2, two), (3, one), (3, two), (4, two)]
    got = sorted((r.doc_id, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 1), (2, 1), (3, 1), (3, 1), (4, 1)]
