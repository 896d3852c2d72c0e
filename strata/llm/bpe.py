"""BPE encoding and decoding (operator 10): speculate and verify.

Words of a text are split off by the vocabulary's own rules. For words not met before, greedy
longest match proposes tokens; one vectorised check then tests every distinct adjacent pair of
all proposals; only words with a failing pair go through exact merging. A proposal whose tokens
each stand for themselves and whose adjacent pairs are all compatible *is* the exact encoding:
a merge across some boundary would have to happen between two neighbours first.
"""

from __future__ import annotations

import gc
import hashlib
import json
import unicodedata
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Fixed values of the public word vocabulary: its word pattern and its white space.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
SPECIAL = " "       # marks a special token among the pieces (no piece holds white space)
LAST = 0xE000       # private-use letters for the last byte of a word
_SEPARATORS = regex.compile("[\x1c-\x1f]")      # str.split() cuts here, the vocabulary doesn't


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable
    Latin-1 stands for itself, the other bytes follow from 256 on in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b) if b in plain else chr(spare))
        spare += b not in plain
    return out


class PairCheck:
    """Which adjacent tokens exact merging would leave apart."""

    def __init__(self, rank: np.ndarray, left: np.ndarray, right: np.ndarray):
        self.rank, self.left, self.right = rank, left, right
        made = np.flatnonzero(rank >= 0)
        keys = left[made] * len(rank) + right[made]
        order = np.argsort(keys)
        self.keys, self.pair_rank = keys[order], rank[made][order]

    def merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of merging a and b; a value above all ranks where they don't merge."""
        key = a * len(self.rank) + b
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[i] == key, self.pair_rank[i], np.int64(1) << 40)

    def apart(self, a: np.ndarray, b: np.ndarray, joined: bool = False) -> np.ndarray:
        """For each pair of tokens: no merge ever crosses their boundary. Merges inside the two
        tokens are undone from the last to the first (the right one last among equal ranks);
        before each, a merge across the boundary must not come earlier. `joined`: the final
        merge of the two itself is allowed."""
        a, b = a.copy(), b.copy()
        fine = np.ones(len(a), bool) if joined else self.merge_rank(a, b) >= 1 << 40
        live = np.flatnonzero(fine)
        while len(live):
            x, y = a[live], b[live]
            rx, ry = self.rank[x], self.rank[y]
            some = np.maximum(rx, ry) >= 0
            live, x, y, rx, ry = live[some], x[some], y[some], rx[some], ry[some]
            undo_right = ry >= rx
            x = np.where(undo_right, x, self.right[x])
            y = np.where(undo_right, self.left[y], y)
            # a left merge of equal rank is applied before the crossing one, a right one after it
            limit = np.where(undo_right, ry, rx - 1)
            ok = self.merge_rank(x, y) > limit
            fine[live[~ok]] = False
            a[live], b[live] = x, y
            live = live[ok]
        return fine


class ByteBPE:
    """A byte-level vocabulary file with merges; `encode` takes the bytes of whole words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        specials = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        model = model["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocab, self.specials = model["vocab"], specials
        size = max([*self.vocab.values(), *specials.values()]) + 1
        self.tokens = [""] * size
        for text, i in [*self.vocab.items(), *specials.items()]:
            self.tokens[i] = text
        rank, left, right = (np.full(size, -1, dtype=np.int64) for _ in range(3))
        self.made = np.empty(len(model["merges"]), dtype=np.int64)      # rank -> token
        for r, m in enumerate(model["merges"]):
            first, second = m.split(" ") if isinstance(m, str) else m
            i = self.vocab[first + second]
            rank[i], left[i], right[i], self.made[r] = r, self.vocab[first], self.vocab[second], i
        if (rank >= 0).sum() != len(self.made):
            raise ValueError("two merges make the same token; pairs can't be undone")
        self.check = PairCheck(rank, left, right)
        made = np.flatnonzero(rank >= 0)
        own = np.ones(size, bool)       # tokens that exact merging makes of their own text
        own[made] = self.check.apart(left[made], right[made], joined=True)
        for i in made[np.argsort(rank[made])]:
            own[i] &= own[left[i]] and own[right[i]]
        self.letters = byte_letters()
        self.letter_codes = np.array([ord(x) for x in self.letters], dtype="<u4")
        self.letter_ids = np.array([self.vocab[x] for x in self.letters], dtype=np.int64)
        self.last_ids = np.array([self.vocab[x + self.suffix] for x in self.letters], dtype=np.int64)
        # a word's last letter is spelt by a letter of its own, so one pass of the automaton over
        # many words on end never proposes a token across two words
        last = {x: chr(LAST + b) for b, x in enumerate(self.letters)}
        spelt = {}
        for text, i in self.vocab.items():
            if own[i]:
                if self.suffix and text.endswith(self.suffix):
                    text = text[:-len(self.suffix) - 1] + last[text[-len(self.suffix) - 1]]
                    spelt[text] = i
                else:
                    spelt[text] = i
                    if not self.suffix:
                        spelt[text[:-1] + last[text[-1]]] = i
        self.longest_match = ahocorasick.Automaton()
        for text, i in spelt.items():
            self.longest_match.add_word(text, i)
        self.longest_match.make_automaton()

    def propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match, left to right: all tokens, and the word each belongs to."""
        joined = np.frombuffer(b"".join(words), dtype=np.uint8)
        ends = np.cumsum([len(w) for w in words]) - 1
        codes = self.letter_codes[joined]
        codes[ends] = joined[ends].astype("<u4") + np.uint32(LAST)
        found = np.fromiter(self.longest_match.iter_long(codes.tobytes().decode("utf-32-le")),
                            dtype=[("end", np.int64), ("token", np.int64)])
        return np.ascontiguousarray(found["token"]), np.searchsorted(ends, found["end"])

    def merge_exactly(self, words: list[bytes]) -> list[list[int]]:
        """In every word the pair of lowest rank, leftmost among equals, again and again until no
        pair merges; all words take a step together."""
        out: list[list[int]] = [[] for _ in words]
        if not words:
            return out
        joined = np.frombuffer(b"".join(words), dtype=np.uint8)
        sizes = np.array([len(w) for w in words])
        ids, ends = self.letter_ids[joined], np.cumsum(sizes) - 1
        ids[ends] = self.last_ids[joined[ends]]
        owner = np.repeat(np.arange(len(words)), sizes)
        none = np.int64(1) << 30            # above every rank
        width = int(sizes.max()).bit_length()           # of a place within a word
        rank = np.full(len(ids), none)
        same = np.flatnonzero(owner[1:] == owner[:-1])
        rank[same] = self.check.merge_rank(ids[same], ids[same + 1])
        while len(ids):
            start = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            best = np.minimum.reduceat((np.minimum(rank, none) << width) | (np.arange(len(ids)) - np.repeat(
                start, np.diff([*start, len(ids)]))), start)
            merges = best >> width < none
            if not merges.all():                        # words that are done leave
                size = np.diff([*start, len(ids)])
                gone = np.repeat(~merges, size)
                for w, a, n in zip(owner[start[~merges]], start[~merges], size[~merges]):
                    out[w] = ids[a:a + n].tolist()
                ids, owner, rank = ids[~gone], owner[~gone], rank[~gone]
                if not len(ids):
                    break
                start = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                best = best[merges]
            at = start + (best & ((1 << width) - 1))
            ids[at] = self.made[best >> width]
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            moved = np.cumsum(stay) - 1
            ids, owner, rank, at = ids[stay], owner[stay], rank[stay], moved[at]
            for k in (at - 1, at):                      # only the new token's neighbours change
                pair = k[(k >= 0) & (k + 1 < len(ids))]
                one = owner[pair] == owner[pair + 1]
                rank[pair[~one]] = none
                pair = pair[one]
                rank[pair] = self.check.merge_rank(ids[pair], ids[pair + 1])
            rank[-1] = none
        return out

    def encode(self, words: list[bytes]) -> list[list[int]]:
        if not words:
            return []
        flat, owner = self.propose(words)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        size = len(self.tokens)
        pairs, back = np.unique(flat[inner] * size + flat[inner + 1], return_inverse=True)
        fine = self.check.apart(pairs // size, pairs % size)
        ends = np.cumsum(np.bincount(owner, minlength=len(words))).tolist()
        tokens = flat.tolist()
        out = [tokens[a:b] for a, b in zip([0, *ends], ends)]
        failed = np.unique(owner[inner][~fine[back]]).tolist()
        for w, ids in zip(failed, self.merge_exactly([words[w] for w in failed])):
            out[w] = ids
        return out

    def decode(self, ids) -> str:
        """Token texts joined by one space (the vocabulary names no decoder)."""
        return " ".join([self.tokens[i] for i in ids])


class Strange:
    """Characters that the library's Unicode tables see otherwise than Python's: their class, lower
    case, composition or combining order differ between the two versions. A character met for
    the first time is tried against the library in several surroundings, once."""

    def __init__(self, library, encode):
        self.library, self.encode = library, encode
        self.fine = {chr(i) for i in range(128)}
        self.strange: set[str] = set()
        first: dict[int, str] = {}              # a mark of every combining class, the same since long
        for i in range(0x300, 0x20000):
            if (c := unicodedata.combining(chr(i))) == unicodedata.ucd_3_2_0.combining(chr(i)):
                first.setdefault(c, chr(i))
        self.marks = [x for c, x in first.items() if c]

    def around(self, x: str) -> list[str]:
        out = [x, f"a{x}", f"{x}a", f"1{x}1", f".{x}.", f"a{x}\u0301", f"A{x}{x}", f" {x} b", f"a{x}'s"]
        if unicodedata.category(x)[0] in "MC":
            out += [f"a{m}{x}" for m in self.marks] + [f"a{x}{m}" for m in self.marks]
        return out

    def learn(self, characters: set[str]):
        new = sorted(characters - self.fine - self.strange)
        for i in range(0, len(new), 2000):
            tries = [(x, t) for x in new[i:i + 2000] for t in self.around(x)]
            want = self.library.encode_batch([t for _, t in tries], add_special_tokens=False)
            for (x, _), got, e in zip(tries, self.encode([t for _, t in tries]), want):
                if got[1] != " ".join(map(str, e.ids)):
                    self.strange.add(x)
            self.fine.update(x for x in new[i:i + 2000] if x not in self.strange)


class TextCodec:
    """Whole texts by a word vocabulary. What a piece of text between white space becomes is
    remembered for at most `limit` pieces, then forgotten. Texts that hold a character on which
    the library's Unicode tables differ from Python's (`Strange`) are left to the library."""

    def __init__(self, path: str, limit: int = 400_000):
        self.bpe = ByteBPE(path)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.odd = Strange(self.library, self._encode_decode)
        self.pattern = regex.compile(WORD_PATTERN)
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.bpe.specials)) + ")")
        self.numbers = [str(i) for i in range(len(self.bpe.tokens))]
        self.ids: dict[str, str] = {}
        self.decoded: dict[str, str] = {}
        self.limit = limit

    @staticmethod
    def _pieces(text: str) -> list[str]:
        """No piece is empty, and each gives at least one token."""
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:                 # lower case letter by letter, without final forms
            text = text.replace("Σ", "σ")
        text = text.lower()
        if _SEPARATORS.search(text):
            return [p for p in regex.split(r"\p{White_Space}+", text) if p]
        return text.split()

    def _learn(self, pieces: set[str]):
        pieces = [p for p in pieces if p not in self.ids]
        if len(self.ids) + len(pieces) > self.limit:
            self._forget()
            return False
        # letters only are one word, whatever they are
        split = {p: [p] if p.isalpha() else self.pattern.findall(p) for p in pieces}
        words = list({w for ws in split.values() for w in ws})
        made = dict(zip(words, self.bpe.encode([w.encode() for w in words])))
        number, token = self.numbers, self.bpe.tokens
        for p, ws in split.items():
            t = made[ws[0]] if len(ws) == 1 else [i for w in ws for i in made[w]]
            self.ids[p] = " ".join([number[i] for i in t])
            self.decoded[p] = " ".join([token[i] for i in t])
        return True

    def _forget(self):
        self.ids.clear()
        self.decoded.clear()
        for x, i in self.bpe.specials.items():
            self.ids[SPECIAL + x], self.decoded[SPECIAL + x] = str(i), x

    def encode_decode(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(number of ids, ids joined by one space, decoded text) of each text."""
        collecting = gc.isenabled()
        gc.disable()                    # many small lists, no cycles
        try:
            self.odd.learn(set().union(*[t for t in texts if not t.isascii()]))
            left = [i for i, t in enumerate(texts) if not self.odd.strange.isdisjoint(t)] if self.odd.strange else []
            if not left:
                return self._encode_decode(texts)
            out: list = [None] * len(texts)
            for i, e in zip(left, self.library.encode_batch([texts[i] for i in left], add_special_tokens=False)):
                out[i] = (len(e.ids), " ".join(map(str, e.ids)), self.library.decode(e.ids, skip_special_tokens=False))
            own = [i for i, x in enumerate(out) if x is None]
            for i, x in zip(own, self._encode_decode([texts[i] for i in own])):
                out[i] = x
            return out
        finally:
            if collecting:
                gc.enable()

    def _encode_decode(self, texts):
        parts = [[p for part in self.special.split(t) for p in
                  ([SPECIAL + part] if part in self.bpe.specials else self._pieces(part))]
                 if "<|" in t else self._pieces(t) for t in texts]
        if not self.ids:
            self._forget()
        pieces = set().union(*parts)
        if not self._learn(pieces):
            limit, self.limit = self.limit, max(self.limit, 2 * len(pieces) + 10)      # this batch must fit
            self._learn(pieces)
            self.limit = limit
        out = []
        for ps in parts:
            ids = " ".join(map(self.ids.__getitem__, ps))
            out.append((ids.count(" ") + 1 if ps else 0, ids, " ".join(map(self.decoded.__getitem__, ps))))
        return out


@lru_cache(maxsize=2)
def codec(path: str) -> TextCodec:
    return TextCodec(path)


def _batches(texts: list[str], chars: int = 2_000_000):
    from .common import chunks
    return chunks([len(t) for t in texts], chars)


def _coded(df: DataFrame, id_col: str, text_col: str, path: str, row, schema: str) -> DataFrame:
    """One row per document: its id, then row(n, ids, decoded)."""
    names = [x.split()[0] for x in schema.split(", ")][1:]

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            coder = codec(path)
            for i, j in _batches(texts):
                rows = [row(*x) for x in coder.encode_decode(texts[i:j])]
                yield pa.RecordBatch.from_pydict(
                    {id_col: batch.column(0).slice(i, j - i), **{n: [r[k] for r in rows] for k, n in enumerate(names)}})
    return df.select(F.col(id_col).cast("long").alias(id_col),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).mapInArrow(run, schema)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col`, `ids` (array of token ids of the whole text), `decoded` (decode of those ids).

    Null and empty texts give no ids and an empty decoded text. One row per input row; other
    columns are not read."""
    return _coded(df, id_col, text_col, path, lambda n, ids, decoded: ([int(i) for i in ids.split()], decoded),
                  f"{id_col} long, ids array<long>, decoded string")


def encode_digest(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col`, n_tokens, ids_sha256, decoded_sha256 of the same encoding."""
    def row(n, ids, decoded):
        return n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
    return _coded(df, id_col, text_col, path, row,
                  f"{id_col} long, n_tokens long, ids_sha256 string, decoded_sha256 string")
