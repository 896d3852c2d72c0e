"""Every stage of the pipeline on its own input, against brute force, and the whole run."""
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
import public_tokenizers
from test_near_dedup import brute as brute_near
from test_pii import brute as brute_pii

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
N = P.REPEATED_BYTES


def docs(spark):
    r = random.Random(11)
    words = {"en": "the and of that with for have this tion ing".split(), "de": "der und ein ich nicht über für mit von ß".split()}
    rows = []
    for i in range(160):
        lang = r.choice(["en", "de"])
        w = [r.choice(words[lang]) + r.choice(["", "x", "er"]) for _ in range(r.choice([30, 90, 300]))]
        if i % 9 == 0:
            w[5:5] = ["joe%d@mail.org" % (i % 4), "1.2.3.4"]
        t = " ".join(w)
        if rows and r.random() < 0.2:
            t = r.choice(rows)[1] or t
        rows.append((i * 2, t, lang if i % 10 else None, "src", len(t)))
    shared = " ".join(r.choice(words["en"]) for _ in range(200))
    own = lambda: " ".join(r.choice(words["en"]) + str(r.randint(0, 9)) for _ in range(300))
    rows += [(1000 + i, f"{own()} {shared} {own()}", "en", "src", 0) for i in range(3)]
    rows += [(2000, None, "en", "s", 0), (2001, "", None, None, None), (2002, "123 !!", "en", "s", 6),
             (4, "the same id with another text and words of that kind", "en", "s", 1), (None, "the null id and that", "en", "s", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    out, current = [docs(spark)], None
    for i, (_, stage) in enumerate(P.STAGES):
        current = stage(spark, out[-1], "unused")
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        current.write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def table(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_and_names(stages):
    assert [n for n, _ in P.STAGES] == ["language_id", "near_dedup", "suffix_array_dedup", "pii", "packing"]
    assert all(s.columns == COLUMNS for s in stages[:-1])


def test_language_stage_drops_only_texts_without_a_language(stages):
    before, after = stages[0].collect(), stages[1].collect()
    gone = {(r.doc_id, r.text) for r in before} - {(r.doc_id, r.text) for r in after}
    assert gone == {(2000, None), (2001, ""), (2002, "123 !!")}
    assert all(r.lang for r in after)


def test_near_stage_keeps_one_of_each_group(stages):
    before = [(r.doc_id, r.text) for r in stages[1].collect() if r.doc_id is not None and r.doc_id != 4]
    want = brute_near(before, 5)
    kept = [r.doc_id for r in stages[2].collect()]
    assert len(kept) == len(set(kept))
    assert set(kept) - {4, None} == {d for d, (_, c, k) in want.items() if k}
    assert None in kept


def test_suffix_stage_removes_repeated_bytes(stages):
    before = {d: (t or "").encode() for d, t in table(stages[2]).items()}
    seen = {}
    for b in before.values():
        for i in range(len(b) - N + 1):
            seen[b[i:i + N]] = seen.get(b[i:i + N], 0) + 1
    after = table(stages[3])
    assert set(after) == set(before)
    removed = 0
    for d, b in before.items():
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - N + 1):
            if seen[b[i:i + N]] > 1:
                gone[i:i + N] = True
        removed += gone.sum()
        assert after[d] == bytes(np.frombuffer(b, np.uint8)[~gone]).decode("utf-8", "ignore")
    assert removed > 0
    assert all(r.n_chars == len(r.text) for r in stages[3].collect())


def test_pii_stage_leaves_no_base_span(stages):
    before, after = table(stages[3]), table(stages[4])
    assert set(before) == set(after)
    assert any(brute_pii(t) for t in before.values())
    for d, t in after.items():
        assert not brute_pii(t)
        if not brute_pii(before[d]):
            assert t == before[d]


def test_packing_stage_places_every_text(stages):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    size = {d: len(lib.encode(t or "", add_special_tokens=False).ids) + 1 for d, t in table(stages[4]).items()}
    got = {}
    for r in stages[5].collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == size


def test_run_over_a_driver_table(spark):
    out = P.run(spark, "/root/testdata/sf0.001")
    assert out.columns[:3] == ["doc_id", "piece", "start"] and out.count() > 100


def test_empty_table(spark):
    empty = docs(spark).where("false")
    for _, stage in P.STAGES:
        assert stage(spark, empty, "unused").count() == 0


def test_language_stage_keeps_an_unlabelled_corpus(spark):
    rows = [(1, "words of some language", None, "s", 1), (2, "über 12", None, "s", 1), (3, "123 !!", None, "s", 1), (4, None, None, "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = P.identify_language(spark, df, "unused")
    assert got.columns == df.columns and {r.doc_id for r in got.collect()} == {1, 2}
