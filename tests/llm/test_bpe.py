"""Operator 10 against the tokenizers library."""
import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strata.llm.bpe import ByteBPE, TextCodec, encode, encode_digest

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts(seed, n=400):
    r = random.Random(seed)
    alphabet = "abcdefghijklmnopqrstuvwxyzABCTHEIN'’  \n\t.,!?-_#$%&@0123456789éÉüßñΣσς中文ñ🙂  \x1c\x1f́İ"
    words = ["the", "internationalization", "don't", "I'LL", "we've", "<|endoftext|>", "<|startoftext|>", "<|x|>", "aaaaaaa",
             "hahahahahaha", "</w>", "123456", "é", "ΟΔΟΣ", "!!!!!!!!", "zzzzzzzzzzzz"]
    out = []
    for _ in range(n):
        if r.random() < 0.5:
            out.append("".join(r.choice(alphabet) for _ in range(r.randint(0, 60))))
        else:
            out.append(r.choice([" ", "", "\n", "\x1e"]).join(r.choice(words) for _ in range(r.randint(0, 12))))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_codec_matches_library(library, seed):
    xs = texts(seed)
    for x, (n, ids, decoded) in zip(xs, TextCodec(PATH).encode_decode(xs)):
        want = library.encode(x, add_special_tokens=False).ids
        assert [int(i) for i in ids.split()] == want and n == len(want), x
        assert decoded == library.decode(want, skip_special_tokens=False), x


def test_characters_of_all_planes(library):
    """Also those on which Python's and the library's Unicode tables differ."""
    r = random.Random(8)
    known = ["é", "\u0558", "\u058b", "\u088f", "\u1c89", "\ua7cb", "\u1df6\u0301", "a\u0301\u1df6", "\u0345", "İ", "ẞ", "ﬃ", "ΑΣ", "Σ."]
    planes = [range(0x80, 0x3000), range(0xa000, 0xd800), range(0xe000, 0x10000), range(0x10000, 0x20000), range(0x20000, 0x110000)]
    xs = list(known)
    for _ in range(6000):
        odd = [chr(r.choice(r.choice(planes))) for _ in range(r.randint(1, 6))]
        xs.append("".join(r.choice([*odd, "a", "B", "1", " ", ".", "\u0301", "\u0323", "'s"]) for _ in range(r.randint(1, 14))))
    codec = TextCodec(PATH)
    got = codec.encode_decode(xs)
    want = [e.ids for e in library.encode_batch(xs, add_special_tokens=False)]
    bad = [x for x, g, w in zip(xs, got, want) if g[1] != " ".join(map(str, w)) or g[2] != library.decode(w, skip_special_tokens=False)]
    assert not bad, (len(bad), bad[:5])
    assert codec.odd.strange and "é" in codec.odd.fine


def test_speculation_equals_exact_merging():
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        bpe = ByteBPE(public_tokenizers.path(name))
        r = random.Random(4)
        tokens = [t for t in bpe.vocab if not t.startswith("<")]
        words = ["".join(r.choice("aehinorst") for _ in range(r.randint(1, 14))).encode() for _ in range(3000)]
        words += ["".join(r.choices(tokens, k=2)).replace("</w>", "").replace("Ġ", "").encode() for _ in range(2000)]
        words = [w for w in words if w]
        exact = bpe.merge_exactly(words)
        assert bpe.encode(words) == exact
        ids, owner = bpe.propose(words)
        assert [bpe.tokens[i] for i in ids] != [bpe.tokens[i] for x in exact for i in x]     # some speculations fail
        assert owner[-1] == len(words) - 1


def test_small_memory_gives_the_same(library):
    xs = texts(5, 200)
    small = TextCodec(PATH, limit=10)
    got = [small.encode_decode([x])[0][1] for x in xs]
    assert got == [" ".join(map(str, library.encode(x, add_special_tokens=False).ids)) for x in xs]


def test_frame(spark, library):
    xs = [*texts(6, 50), None, "", "word " * 30_000]
    df = spark.createDataFrame([(i, x, "z") for i, x in enumerate(xs)] + [(None, "a", "z"), (0, xs[0], "z")],
                               "doc_id long, text string, ids string")
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encode_digest(df.repartition(3), PATH).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = set()
    for i, x in [*enumerate(xs), (None, "a")]:
        ids = library.encode(x or "", add_special_tokens=False).ids
        want.add((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert got == want
    assert encode(df.where("doc_id is null"), PATH).first().decoded == "a</w>"
    assert encode_digest(df.where("false"), PATH).collect() == []


def test_a_word_longer_than_four_million_bytes():
    bpe = ByteBPE(public_tokenizers.path("byte_bpe_50k.json"))
    n = (1 << 22) + 10
    short = bpe.merge_exactly([b"\x01\x01the"])[0]
    assert len(short) < 5
    got = bpe.merge_exactly([b"\x01" * n + b"the"])[0]
    assert got[-len(short):] == short and got[:n] == [short[0]] * n and len(got) == n - 2 + len(short)
