"""Operators 1 and 9: gradients, held-out accuracy, and the rule about what may be learnt."""
import zlib

import numpy as np
import pytest

from strata.llm import language_id, quality
from strata.llm.common import documents

SF, LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def is_held_out(d):
    return zlib.crc32(str(d).encode()) % 4 == 2


def test_backpropagation_through_time_matches_differences():
    net = language_id.Network(["x", "y", "z"], hidden=3, seed=1)
    r = np.random.default_rng(0)
    data, y = r.integers(97, 101, (6, 5), dtype=np.uint8), np.array([0, 1, 2, 1, 0])
    _, grads = net.gradients(data, y)
    for k, v in net.p.items():
        flat = v.ravel()
        for i in r.choice(len(flat), 25) if k[:5] != "table" else [v.shape[1] * g + b for g in range(v.shape[0]) for b in (97, 99)]:
            old, eps = flat[i], 1e-2
            flat[i] = old + eps
            up = net.gradients(data, y)[0]
            flat[i] = old - eps
            down = net.gradients(data, y)[0]
            flat[i] = old
            assert abs((up - down) / (2 * eps) - grads[k].ravel()[i]) < 2e-3, (k, i)


@pytest.fixture(scope="module")
def network(spark):
    return language_id.train(documents(spark, SF))


def test_language_accuracy(spark, network):
    docs = documents(spark, SF)
    got = {r.doc_id: r for r in language_id.predict(docs, network).collect()}
    rows = docs.collect()
    test = [r for r in rows if is_held_out(r.doc_id) and r.lang]
    assert len(got) == len(rows)
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in test]) > 0.97
    assert all(0 <= g.score <= 1 for g in got.values())


def test_language_edges(spark, network):
    df = spark.createDataFrame([(1, None, "de"), (2, "", None), (3, "123 !! ²", "en"), (None, "the thing " * 2000, "x")],
                               "doc_id long, text string, lang_pred string")
    got = language_id.predict(df, network, keep=["doc_id", "lang_pred"], out=("l", "s")).collect()
    assert sorted((str(r.doc_id), r.l) for r in got) == [("1", "und"), ("2", "und"), ("3", "und"), ("None", "en")]
    assert language_id.predict(df.where("false"), network).collect() == []
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language_id.train(empty) is None
    assert {r.lang_pred for r in language_id.predict(df, None).collect()} == {"und"}


def test_quality_accuracy(spark):
    """On about a thousand held-out labels (the smaller tables hold a dozen bad ones)."""
    docs, labels = documents(spark, LARGER), spark.read.parquet(f"{LARGER}/labels.parquet")
    model = quality.train(docs, labels)
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}
    test = [(got[r.doc_id], r.quality) for r in labels.collect() if is_held_out(r.doc_id)]
    assert all(g.held_out == is_held_out(d) for d, g in got.items())
    assert np.mean([g.predicted == y for g, y in test]) > 0.97
    good, bad = ([g.score for g, y in test if y == k] for k in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.98


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs, labels = documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 1 - quality "
                               "else quality end as quality")
    assert quality.train(docs, labels) == quality.train(docs, turned)


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "text")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.train(docs, labels)
    assert [r.score for r in quality.score(docs, model).collect()] == [0.5] * 3
    assert quality.score(docs.where("false"), model).collect() == []
    one = quality.train(docs, spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, None)], "doc_id long, quality int"))
    assert all(0 < r.score <= 1 for r in quality.score(docs, one).collect())


def test_a_text_does_not_depend_on_its_neighbours():
    """Short texts beside long ones give what they give alone, and what a plain pass byte by byte gives."""
    net = language_id.Network(["x", "y", "z"], hidden=8, seed=1)
    r = np.random.default_rng(4)
    texts = [bytes(r.integers(97, 123, n).astype(np.uint8)) for n in (1, 2, 5, 40, 127, 128, 129, 300, 1000)]
    together = net.pooled(texts)
    assert np.allclose(together, [net.pooled([t])[0] for t in texts], atol=1e-5)
    assert np.allclose(together, net.pooled(texts[::-1])[::-1], atol=1e-5)
    for t, p in zip(texts, together):
        parts = [np.frombuffer(t[i:i + language_id.SEGMENT], dtype=np.uint8)[:, None] for i in range(0, len(t), language_id.SEGMENT)]
        assert np.allclose(p, sum(net.probabilities(x).sum(axis=0)[:, 0] for x in parts) / len(t), atol=1e-5)


def test_repeated_rows_and_a_very_long_text(spark):
    docs = [(i, ["the and of that with", "der und ein ich nicht"][i % 2] * 5, ["en", "de"][i % 2]) for i in range(60)]
    docs += [(99, "der und ein ich nicht " * 20_000, None), (0, docs[0][1], "en")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(4)
    found = language_id.predict(df, language_id.train(df)).collect()
    assert len(found) == len(docs) and {r.lang_pred for r in found if r.doc_id == 99} == {"de"}
    assert len({(r.lang_pred, r.score) for r in found if r.doc_id == 0}) >= 1
