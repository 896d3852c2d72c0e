"""Operator 11 against scoring every document for every item."""
import math
import random
import re
from collections import Counter

import pytest

from strata.llm import lexical
from strata.llm.lexical import search, terms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=10):
    bags = [(i, Counter(split(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in items:
        scored = []
        for i, b in bags:
            m = 100 - 75 + 75 * sum(b.values()) * n_docs // total
            s = sum(w[t] * (10 ** 9 * b[t] // (1000 * b[t] + 8 * m)) for t in split(text) if t in b)
            if s > 0:
                scored.append((-s, i is None, i))
        out += [(item, k, i, -s) for k, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1)]
    return sorted(out)


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, 9) for i, t in docs], "doc_id long, text string, item_id int").repartition(5),
            spark.createDataFrame([(i, t, 9) for i, t in items], "item_id long, text string, doc_id int"))


def corpus(seed, n=300):
    r = random.Random(seed)
    words = ["the", "The", "ÉTÉ", "été", "x1", "1x", "中文", "straße", "a", "b", "c", *[f"w{i}" for i in range(60)]]
    docs = [(i, r.choice([" ", ", ", "-", "\x00", "\n"]).join(r.choices(words, k=r.randint(0, 30)))) for i in range(n)]
    docs += [(1000 + i, "the the a b") for i in range(120)]             # a third are copies
    docs += [(2000 + i, "the a b, the") for i in range(30)]             # another order: the same bag
    docs += [(3000, None), (3001, ""), (3002, "... !"), (None, "w1 w2"), (5, "w1 w2"), (5, "w1 w2"), (3003, "w7 " * 50_000)]
    r.shuffle(docs)
    items = [(i, " ".join(r.choices(words, k=r.randint(1, 12)))) for i in range(30)]
    items += [(100, None), (101, ""), (102, "nowhere to be found"), (103, "the the THE a"), (104, "w1 w2"), (None, "b")]
    return docs, items


def test_terms():
    for t in ["", "A-b_C", "ÀÉ İx ²", "中文,9a\x7fz", "a\x80b c", "Straße\x00Z"]:
        assert [x.decode() for x in terms(t.encode())] == split(t)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    docs, items = corpus(seed)
    got = [tuple(r) for r in search(*frames(spark, docs, items)).collect()]
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(got, key=key) == sorted(brute(docs, items[:-1]) + [(None, *r[1:]) for r in brute(docs, [(0, "b")])], key=key)


def test_blocks_of_items_and_few_places(spark, monkeypatch):
    docs, items = corpus(3, 80)
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 120)
    got = sorted(tuple(r) for r in search(*frames(spark, docs, items[:-1]), top=3).collect())
    assert got == brute(docs, items[:-1], top=3)


def test_scores_too_large_for_floating_point(spark, monkeypatch):
    docs, items = corpus(4, 60)
    monkeypatch.setattr(lexical, "EXACT", 1.0)
    assert sorted(tuple(r) for r in search(*frames(spark, docs, items[:-1])).collect()) == brute(docs, items[:-1])


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "a")], [(1, "a")])
    assert search(docs.where("false"), items).collect() == []
    assert search(docs, items.where("false")).collect() == []
    assert search(docs.where("false"), items).dtypes == search(docs, items).dtypes
