"""Operators 3 and 4 against brute force: ties, overlaps, copies, nulls, clashing columns."""
import hashlib
import random

import pytest

from strata.llm.substring_dedup import remove_repeated_words, repeated_words_digest
from strata.llm.suffix_dedup import remove_repeated_bytes, repeated_bytes_digest


def brute_words(docs, n):
    first = {}
    for d, t in docs:
        w = (t or "").encode().split()
        for i in range(len(w) - n + 1):
            key = tuple(w[i:i + n])
            first[key] = min(first.get(key, d), d)
    out = {}
    for d, t in docs:
        w = (t or "").encode().split()
        gone = set()
        for i in range(len(w) - n + 1):
            if first[tuple(w[i:i + n])] < d:
                gone.update(range(i, i + n))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def brute_bytes(docs, n):
    seen = {}
    for d, t in docs:
        b = (t or "").encode()
        for i in range(len(b) - n + 1):
            seen[b[i:i + n]] = seen.get(b[i:i + n], 0) + 1
    out = {}
    for d, t in docs:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - n + 1):
            if seen[b[i:i + n]] > 1:
                gone[i:i + n] = [True] * n
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed):
    r = random.Random(seed)
    vocab = ["a", "b", "é", "the", "Zu", " x", "long" * 5]
    text = lambda n: r.choice([" ", "\n", "\t "]).join(r.choice(vocab) for _ in range(n))
    passages = [text(r.randint(20, 160)) for _ in range(5)]
    docs = []
    for i in range(60):
        kind = r.randint(0, 6)
        t = text(r.randint(0, 60))
        if kind < 3:
            t += " " + r.choice(passages) + " " + text(r.randint(0, 40))
        elif kind == 3 and docs:
            w = (r.choice(docs)[1] or "").split(" ")
            if w:
                w[r.randrange(len(w))] = "edit"
            t = " ".join(w)
        elif kind == 4 and docs:
            t = r.choice(docs)[1]
        elif kind == 5:
            t = "-" * r.randint(0, 900)
        docs.append((i * 3 - 20, t))
    docs += [(1000, None), (1001, ""), (1002, " \n ")]
    r.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed,n", [(1, 50), (2, 12), (3, 7)])
def test_words_match_brute_force(spark, seed, n):
    docs = corpus(seed)
    df = spark.createDataFrame([(d, t, "x", 5) for d, t in docs], "doc_id long, text string, h string, n_words int")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in repeated_words_digest(df.repartition(4), n).collect()}
    assert got == brute_words(docs, n)


@pytest.mark.parametrize("seed,n", [(1, 400), (2, 60), (3, 20)])
def test_bytes_match_brute_force(spark, seed, n):
    docs = corpus(seed)
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, active string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in repeated_bytes_digest(df.repartition(4), n).collect()}
    assert got == brute_bytes(docs, n)


def test_edges(spark):
    schema = "doc_id long, text string"
    empty = spark.createDataFrame([], schema)
    assert repeated_words_digest(empty).collect() == [] and repeated_bytes_digest(empty).collect() == []
    long_text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(None, long_text), (5, long_text), (5, long_text), (5, "x")], schema)
    words = sorted(((r.doc_id, r.n_words, r.n_removed) for r in repeated_words_digest(df).collect()), key=str)
    assert words == [(5, 1, 0), (5, 60, 60), (5, 60, 60), (None, 60, 0)]
    got = remove_repeated_bytes(df, 50, keep=["doc_id", "text"]).select("doc_id", "kept_text").collect()
    assert sorted((str(r.doc_id), r.kept_text) for r in got) == [("5", ""), ("5", ""), ("5", "x"), ("None", "")]
    assert remove_repeated_words(df, 50).where("doc_id = 5 and kept_text = ''").count() == 2


def test_long_documents_in_blocks(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from strata.llm import repeats, suffix_dedup
    r = random.Random(9)
    text = "".join(r.choice("abcde fg") for _ in range(5000)).encode()
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([text])], names=["d", "t", "b"])
    spec = suffix_dedup.spec(60)

    def windows():
        out = {}
        for rows in repeats._anchor_rows(spec)([batch]):
            p, first, last = repeats.unpacked(rows.column("at").to_numpy())
            for h, a, f, l in zip(rows.column("h").to_pylist(), p, first, last):
                out.update({s: (h, a) for s in range(f, l + 1)})
        return out

    whole = windows()
    assert sorted(whole) == list(range(5000 - 59))
    monkeypatch.setattr(repeats, "CHUNK", 700)
    assert windows() == whole
    assert np.array_equal(np.concatenate([b[:700] for _, b in repeats.blocks(np.arange(5000), 60)])[:4941], np.arange(4941))
