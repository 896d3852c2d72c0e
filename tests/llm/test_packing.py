"""Operator 8: pieces against the library, places against the rules, plans against brute force."""
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from strata.llm.packing import TokenBytes, fullest, pack, plan

PATH = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_rank_file_gives_the_library_ids():
    r = random.Random(7)
    both, lib = TokenBytes(PATH, RANKS), Tokenizer.from_file(PATH)
    alphabet = "abcdefghij ABC'sñéÜß0123456789  \n\t\r\x0b\x1c\x85\xa0.,!?|$<>²½ªºµĀɏ"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 80))) for _ in range(4000)]
    texts += ["<|endoftext|> a", "中文 text", "a\u2003b", "e\u0301", "x" * 9000, " " * 9000 + "y", "\n" * 50 + "x", "it's we'll I'VE"]
    assert sum(map(both.plain, texts)) > 3500
    assert both.encode(texts) == [np.array(e.ids, dtype="<u4").tobytes() for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_fullest_against_all_subsets():
    r = random.Random(1)
    for _ in range(200):
        available = {r.randint(1, 30): r.randint(1, 3) for _ in range(r.randint(0, 5))}
        room = r.randint(0, 60)
        items = [n for n, c in available.items() for _ in range(c)]
        best = max((s for k in range(len(items) + 1) for s in map(sum, itertools.combinations(items, k)) if s <= room), default=0)
        used = fullest(available, room)
        assert sum(n * c for n, c in used.items()) == best
        assert all(c <= available[n] for n, c in used.items())


def test_plan_uses_each_piece_once():
    r = random.Random(2)
    histogram = {r.randint(1, 512): r.randint(1, 5000) for _ in range(200)} | {512: 1000}
    bins = plan(histogram, 512)
    used = {}
    for bin_, times in bins:
        assert 0 < sum(n * c for n, c in bin_.items()) <= 512
        for n, c in bin_.items():
            used[n] = used.get(n, 0) + c * times
    assert used == histogram
    total = sum(n * c for n, c in histogram.items())
    big = sum(c for n, c in histogram.items() if n > 256)
    assert sum(t for _, t in bins) <= max(total / 512, big) * 1.03 + 2


def test_pack(spark):
    r = random.Random(3)
    xs = ["".join(r.choice(["the ", " x", "\n\n", "  a", "é", "<|endoftext|>", "don't ", "42 ", " "]) for _ in range(r.choice([0, 5, 50, 400])))
          for _ in range(150)] + [None, "", "word " * 5000]
    rows = [(i * 2, x, 1) for i, x in enumerate(xs)] + [(4, xs[2], 1), (None, "null id", 1)]
    got = pack(spark.createDataFrame(rows, "doc_id long, text string, part int").repartition(4), PATH, capacity=128, rank_path=RANKS).collect()
    lib = Tokenizer.from_file(PATH)
    want = []
    for d, x, _ in rows:
        ids = lib.encode(x or "", add_special_tokens=False).ids + [0]
        size, at, p = (len(ids) - 1) % 128 + 1, 0, 0
        while at < len(ids):
            part = np.array(ids[at:at + size], dtype="<u4").tobytes()
            want.append((str(d), p, at, size, zlib.crc32(part)))
            at, size, p = at + size, 128, p + 1
    assert sorted((str(g.doc_id), g.piece, g.start, g.length, g.ids_crc32) for g in got) == sorted(want)
    by = {}
    for g in got:
        by.setdefault(g.sequence_id, []).append((g.offset, g.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 128
    assert len(by) <= sum(w[3] for w in want) / 128 * 1.05 + 2
    assert pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
