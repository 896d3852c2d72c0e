"""Operator 5: edits and neighbours by hand, likeness against exact Jaccard."""
import hashlib
import random

from strata.llm.fingerprints import compare_with_edits, edited, fingerprint, likeness, signatures


def docs():
    r = random.Random(1)
    out = [(i * 3 - 30, " ".join(r.choice("abcdefghij") * 2 + str(r.randint(0, 99)) for _ in range(r.choice([0, 1, 4, 30, 200]))))
           for i in range(80)]
    return out + [(900, None), (901, "ünï" * 7), (902, "")]


def test_edits_and_neighbours(spark):
    rows = sorted(docs())
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, part int").repartition(5)
    got = {r.doc_id: r for r in compare_with_edits(df).collect()}
    assert len(got) == len(rows)
    for i, (d, t) in enumerate(rows):
        t, following = t or "", rows[(i + 1) % len(rows)][1] or ""
        new = edited(t, following)
        assert new == t[:len(t) - len(t) // 4] + following[:len(t) // 4]
        g = got[d]
        assert g.n_chars == len(t) and g.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        own, ed, nx = signatures([t.encode(), new.encode(), following.encode()])
        assert g.near_edited == likeness(own, ed) and g.near_next == likeness(own, nx)
    prints = {r.doc_id: r.fingerprint for r in fingerprint(df).collect()}
    assert {d: g.fingerprint for d, g in got.items()} == prints


def test_likeness_estimates_jaccard():
    r = random.Random(2)
    words = [str(r.random()) for _ in range(3000)]
    a, b = " ".join(words).encode(), " ".join(words[:2000]).encode()
    sa, sb = signatures([a, b])
    assert abs(likeness(sa, sb) - 2 / 3) < 0.2
    assert (signatures([a])[0] == sa).all()


def test_edges(spark):
    schema = "doc_id long, text string"
    assert compare_with_edits(spark.createDataFrame([], schema)).collect() == []
    one = compare_with_edits(spark.createDataFrame([(7, "abcdefgh")], schema)).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and one[0].near_next == 1.0
    same = compare_with_edits(spark.createDataFrame([(None, "x y"), (1, "x y"), (1, "x y"), (None, None)], schema)).collect()
    assert len(same) == 4


def test_similar_pairs_equal_brute_force(spark):
    """Copies and near copies that are not adjacent by id: links are true, components are whole."""
    from strata.llm.similar import similar
    r = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.choice([3, 30, 120])))) for i in range(60)]
    for i in range(60, 140):
        w = r.choice(rows)[1].split()
        for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
            w[r.randrange(len(w))] = r.choice(words)
        rows.append((i, " ".join(w)))
    rows += [(500, None), (501, ""), (None, rows[0][1])]
    r.shuffle(rows)

    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {d: shingles(t) for d, t in rows if d is not None}
    pairs = {(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}

    def components(links):
        root = {d: d for d in sets}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in links:
            a, b = sorted((find(a), find(b)))
            root[b] = a
        return {d: find(d) for d in sets}

    got = {(x.a, x.b) for x in similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got <= pairs and any(b - a > 1 for a, b in got)
    assert components(got) == components(pairs)


def test_bands_name_each_text_once(monkeypatch):
    import pyarrow as pa

    from strata.llm import fingerprints, near_dedup, similar
    texts = [b"One two three four five six", b"", b"x y", b" \n", b"a a a a a a a a"]
    named, of = [], fingerprints.shingle_names

    def counted(names, k):
        named.append(len(names))
        return of(names, k)

    for module in (fingerprints, near_dedup):
        monkeypatch.setattr(module, "shingle_names", counted)
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(texts, pa.binary())], names=["d", "text"])
    got = pa.Table.from_batches(similar._banded([batch])).to_pylist()
    assert sorted(named) == [0, 0, 2, 6, 8]
    bands = similar.signature_bands(signatures(texts)).view("int64").tolist()
    assert [r["bands"] for r in got] == [b if r["n"] else [] for r, b in zip(got, bands)]
    assert [r["n"] for r in got] == [2, 0, 1, 0, 1]
    for r, t in zip(got, texts):
        s = near_dedup.shingle_set(5)(t)
        sums = [int(near_dedup.mixed(x).sum(dtype="uint64").view("int64")) for x in (s, ~s)]
        assert [r["s1"], r["s2"]] == sums
