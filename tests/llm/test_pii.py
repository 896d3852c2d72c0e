"""Operator 7: base spans against the plain patterns, disclosure against a count by hand."""
import hashlib
import random
import re

from strata.llm.pii import Disclosure, base_spans, find, listed, luhn, sanitise

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            if k == 1 and max(int(x) for x in m[0].split(".")) > 255:
                continue
            if k == 2 and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if k == 3 and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_equal_plain_patterns():
    r = random.Random(1)
    parts = ["a@b.c", "@", ".", "x%y@z-1.q.w", "1.2.3.4", "256.1.1.1", "0000000000255.1.1.1", "4111 1111 1111 1111", "4111-1111",
             "+1 (234) 555-0101", "+", "(", ")", "-", " ", "12", "9", "é", "+49 30 123456", "a.b", "1.1.1", "5500005555555559"]
    for _ in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 14)))
        assert base_spans(text) == brute(text), text
    assert base_spans("x" * 300_000 + "." * 300_000 + "1" * 300_000 + "+1" * 100_000 + "@") == []
    assert listed(base_spans("mail a@b.c and 1.2.3.4")) == "email:5:10,ip:15:22"


def corpus():
    docs = [(i, f"some ordinary words here about nothing number {i % 7}") for i in range(40)]
    docs += [(100 + i, f"some people say Zorbal writes to joe@x.org about words {i}") for i in range(4)]
    docs += [(200, "a lone remark, call +1 (234) 555-0101 about words"), (201, None), (202, "")]
    return docs


def test_disclosing_terms(spark):
    df = spark.createDataFrame([(d, t, "k") for d, t in corpus()], "doc_id long, text string, near string").repartition(3)
    got = {r.doc_id: r for r in find(df, Disclosure(window=3, support=3)).collect()}
    text = dict(corpus())[101]
    a = text.index("joe@x.org")
    z, w = text.index("Zorbal"), text.index("writes")
    # in all 4 documents with the address and in no other: the whole information; common words are below
    assert got[101].spans == f"term:{z}:{z + 6},term:{w}:{w + 6},term:{text.index('to ')}:{text.index('to ') + 2},email:{a}:{a + 9}"
    assert (got[101].n_email, got[200].n_phone, got[201].spans, got[202].spans) == (1, 1, "", "")
    for d, t in corpus():
        assert got[d].base_sha256 == hashlib.sha256(listed(brute(t or "")).encode()).hexdigest()


def test_sanitise_keeps_rows_and_columns(spark):
    rows = [(d, t, "k") for d, t in corpus()] + [(None, "x@y.zz", "k"), (200, corpus()[-3][1], "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    out = sanitise(df, Disclosure(window=3, support=3))
    assert out.columns == df.columns
    got = sorted((str(r.doc_id), str(r.text)) for r in out.collect())
    assert len(got) == len(rows)
    assert ("None", "[EMAIL]") in got and ("201", "None") in got and ("202", "") in got
    assert ("101", "some people say    [EMAIL] about words 1") in got
    assert find(df.where("false")).collect() == []


def test_two_documents_and_numbers_disclose_at_any_distance(spark):
    """By default two meetings are evidence, wherever in the document; one is not."""
    far = " ".join(f"plain{i}" for i in range(30))
    docs = [(i, f"ordinary {far} talk 17") for i in range(60)]
    docs += [(100 + i, f"Zorbal 90125 {far} ordinary talk joe@x.org once{i}") for i in range(2)]
    docs += [(200, f"Hapax {far} ann@y.org")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.spans for r in find(df).collect()}
    a = docs[60][1].index("joe@x.org")
    assert got[100] == f"term:0:6,term:7:12,email:{a}:{a + 9}"
    assert got[200] == listed(base_spans(docs[62][1])) and got[0] == ""
    assert {r.doc_id: r.text for r in sanitise(df).collect()}[100] == f"  {far} ordinary talk [EMAIL] once0"


def test_removed_numbers_uncover_no_new_entity(spark):
    docs = [(i, f"plain words {i % 3}") for i in range(40)] + [(100 + i, "see 999.1.2.3.4 or joe@x.org") for i in range(2)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert not any(base_spans(r.text) for r in sanitise(df).collect())


def test_filter_passes_every_candidate_and_few_others(spark):
    from strata.llm.pii import _Filter, _slots
    wanted = [f"wörd{i}" for i in range(30_000)] + ["", "a", "漢字"]
    passes = _Filter(_slots(spark.createDataFrame([(w,) for w in wanted], "term string"), "term"))
    assert all(map(passes, wanted))
    assert sum(passes(f"other{i}") for i in range(20_000)) < 200
