"""Operator 12 against the sentencepiece library."""
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from strata.llm.pieces import Pieces, TextPieces, encode_pieces, pieces_digest, unit, words

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def pieces():
    return Pieces(PATH)


def texts(pieces, seed, n=600):
    r = random.Random(seed)
    normal = [pieces.surface[i] for i in pieces.normal]
    letters = "abcdeinorst  ▁\n\t.,é中文日'’AB01🙂"
    out = ["", " ", "  ", "▁", " a  b ", "\n", "<s></s><unk><0x41>", "\x00", "é", "a" * 200, "▁" * 70, "x" + " " * 33 + "y"]
    for _ in range(n):
        out.append("".join(r.choice(letters) for _ in range(r.randint(0, 60))))
        out.append(r.choice(["", " ", "  "]).join(r.choice(normal) for _ in range(r.randint(1, 9))))
        out.append("".join(r.choice(" ▁a") for _ in range(40)))
        out.append("".join(chr(r.choice([r.randrange(32, 0xd800), r.randrange(0xe000, 0x110000), 32, 97])) for _ in range(20)))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_codec_matches_library(library, pieces, seed):
    xs = texts(pieces, seed)
    for x, (ids, decoded) in zip(xs, TextPieces(PATH).encode_decode(xs)):
        want = library.encode(x, add_bos=True, add_eos=True)
        assert np.frombuffer(ids, dtype="<u4").tolist() == want, x
        assert decoded == library.decode(want) == pieces.decode(want), x


def test_compatible_by_undoing_and_by_merging_agree(pieces):
    r = np.random.default_rng(5)
    plain = np.array([i for i in pieces.normal if pieces.plain[i]])
    a, b = r.choice(plain, 40_000), r.choice(plain, 40_000)
    short = plain[pieces.length[plain] <= 2]
    a, b = np.concatenate([a, r.choice(short, 40_000)]), np.concatenate([b, r.choice(short, 40_000)])
    want = pieces.merged(a, b)
    assert (pieces.undone(a, b) == want).all() and 0 < want.sum() < len(want)
    assert (pieces.compatible(a, b) == want).all() and (pieces.compatible(a, b) == want).all()


def test_the_table_equals_exact_merging(pieces):
    r = random.Random(7)
    units = [unit("".join(r.choice("theinagrs ") for _ in range(r.randint(1, 14)))) for _ in range(3000)]
    ids, begin = pieces.encode_units(units)
    chars = pieces.char_id[pieces.class_of[[ord(c) for u in units for c in u]]]
    want, owner = pieces.merge(chars, np.repeat(np.arange(len(units)), [len(u) for u in units]))
    assert ids.tolist() == want.tolist() and np.diff(begin).tolist() == np.bincount(owner, minlength=len(units)).tolist()


def test_small_memory_gives_the_same(library, pieces):
    xs = texts(pieces, 9, 40)
    small = TextPieces(PATH, limit=10)
    for x in xs:
        assert np.frombuffer(small.encode_decode([x])[0][0], dtype="<u4").tolist() == library.encode(x, add_bos=True, add_eos=True)


def test_words():
    assert words("a b") == ["a", "b"] and words("") == [] and words(" ") == [" "]
    assert "".join(unit(w) for w in words("  a▁b  ")) == "▁▁▁a▁b▁▁"


def test_frame(spark, library, pieces):
    long = "antidisestablishmentarianism" * 3000 + " word" * 30_000
    xs = [*texts(pieces, 6, 20), None, "", long]
    df = spark.createDataFrame([(i, x, "z") for i, x in enumerate(xs)] + [(None, "a", "z"), (0, xs[0], "z")],
                               "doc_id long, text string, ids string")
    got = sorted((r.doc_id is None, r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)
                 for r in pieces_digest(df.repartition(3), PATH).collect())
    want = []
    for i, x in [*enumerate(xs), (None, "a"), (0, xs[0])]:
        ids = library.encode(x or "", add_bos=True, add_eos=True)
        want.append((i is None, i, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert got == sorted(want)
    first = encode_pieces(df.where("doc_id is null"), PATH).first()
    assert first.ids == library.encode("a", add_bos=True, add_eos=True) and first.decoded == "a"
    assert pieces_digest(df.where("false"), PATH).collect() == []
