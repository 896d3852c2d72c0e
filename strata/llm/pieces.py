"""SentencePiece encoding and decoding (operator 12): a merge-type prefix table.

A merge-type vocabulary joins, again and again, the two neighbours whose text together is the
piece of the best score, leftmost among equals. Two facts turn this into a table over prefixes:

* tokens t1..tn are the encoding of their joined text exactly if each alone is the encoding of its
  own text and every two neighbours are *compatible* (the encoding of the two texts joined is the
  two tokens): up to the first merge across a boundary, what happens in two neighbours does not
  depend on what stands around them;
* so a prefix of an encoding is the encoding of a prefix, and every prefix has one last token.

An automaton finds all pieces that end at a place. For places in growing distance from their
segment's start, the longest of them is tried first: it is the prefix's last token if it is
compatible with the last token of the prefix before it. Ids are then recovered backwards. All
words of a batch take each step together, in numpy.
"""

from __future__ import annotations

import gc
import hashlib
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks

SPACE = "▁"                    # stands for a space among the pieces
NEVER = np.int64(1) << 40           # above every rank
MEMO_BITS = 21                      # places of the memory of compatible pairs


class Pieces:
    """The vocabulary of a merge-type model with byte fallback and no normalisation."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.size, self.begin, self.end = n, sp.bos_id(), sp.eos_id()
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int64)
        self.surface = [sp.id_to_piece(i) for i in range(n)]
        for i in (self.begin, self.end):
            self.surface[i] = ""
        self.byte_of = {int(i): b for b, i in enumerate(self.byte_ids)}
        self.part = {i for i, b in self.byte_of.items() if b > 127}         # of a longer character
        self.alone = [chr(self.byte_of[i]) if i in self.byte_of else x for i, x in enumerate(self.surface)]
        self.normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.id_of = {self.surface[i]: i for i in self.normal}
        # best score first; equal scores share a rank, so among them the leftmost pair goes first
        score = np.array([sp.get_score(i) for i in self.normal])
        best, place = np.unique(-score, return_inverse=True)
        self.rank = np.full(n, -1, dtype=np.int64)
        self.rank[self.normal] = place
        self.shared = np.zeros(n, bool)
        self.shared[self.normal] = np.bincount(place)[place] > 1
        self.length = np.array([len(x) for x in self.surface], dtype=np.int64)
        self._joins()
        self._classes()
        self._trees()
        self.automaton = ahocorasick.Automaton()
        for text, i in self.id_of.items():
            if self.own[i]:
                self.automaton.add_word(text, i)
        self.automaton.make_automaton()
        self.memo = np.full(1 << MEMO_BITS, -1, dtype=np.int64)
        for probe in ("", "  a b ", "ＡＢ é\t<s>", f"x{SPACE}y\n"):
            if list(self.encode(probe)) != sp.encode(probe, add_bos=True, add_eos=True):
                raise ValueError("the model normalises its text or is not of the merge type")

    def _joins(self):
        """Every way to cut a piece into two pieces: (left, right) -> the piece."""
        cuts = [(a * self.size + b, i) for text, i in self.id_of.items() for k in range(1, len(text))
                if (a := self.id_of.get(text[:k])) is not None and (b := self.id_of.get(text[k:])) is not None]
        cuts.sort()
        self.join_key, self.join_made = map(np.array, zip(*cuts))

    def _classes(self):
        """Characters by number (0: in no piece), and which two can stand side by side in a piece;
        no merge ever crosses any other two."""
        alphabet = sorted({x for text in self.id_of for x in text})
        self.class_of = np.zeros(0x110000, dtype=np.uint16)
        self.class_of[[ord(x) for x in alphabet]] = np.arange(1, len(alphabet) + 1)
        self.char_id = np.full(len(alphabet) + 1, -1, dtype=np.int64)
        for x, c in zip(alphabet, range(1, len(alphabet) + 1)):
            if x not in self.id_of:
                raise ValueError("a letter of the pieces is no piece itself")
            self.char_id[c] = self.id_of[x]
        self.beside = np.zeros((len(alphabet) + 1,) * 2, dtype=bool)
        for text in self.id_of:
            c = self.class_of[[ord(x) for x in text]]
            self.beside[c[:-1], c[1:]] = True
        space = self.class_of[ord(SPACE)]
        if self.beside[[c for c in range(len(alphabet) + 1) if c != space], space].any():
            raise ValueError("a piece holds a space after another character; words can't be cut apart")

    def joined(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of a and b side by side; NEVER where they are no piece."""
        key = a * self.size + b
        i = np.minimum(np.searchsorted(self.join_key, key), len(self.join_key) - 1)
        made = self.join_made[i]
        return np.where(self.join_key[i] == key, self.rank[made], NEVER), made

    def merge(self, ids: np.ndarray, owner: np.ndarray, watch=None) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of many strings at once (ids of their characters; owner: the string, rising).
        Returns what is left. watch(left, right, made) is told of every merge."""
        while len(ids) > 1:
            rank, made = self.joined(ids[:-1], ids[1:])
            rank[owner[1:] != owner[:-1]] = NEVER
            rank = np.append(rank, NEVER)
            start = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            size = np.diff(np.append(start, len(ids)))
            place = np.arange(len(ids)) - np.repeat(start, size)
            width = int(size.max()).bit_length()
            best = np.minimum.reduceat((rank << width) | place, start)
            go = best >> width < NEVER
            if not go.any():
                break
            at = start[go] + (best[go] & ((1 << width) - 1))
            if watch:
                watch(ids[at], ids[at + 1], made[at])
            ids = ids.copy()
            ids[at] = made[at]
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            ids, owner = ids[stay], owner[stay]
        return ids, owner

    def _trees(self):
        """left, right: the last merge of each piece's own encoding; own: the pieces that their own
        text is encoded as (no other piece is ever used); plain: merges come in rising rank."""
        texts = [self.surface[i] for i in self.normal]
        chars = self.char_id[self.class_of[[ord(x) for t in texts for x in t]]]
        sizes = self.length[self.normal]
        self.left, self.right = (np.full(self.size, -1, dtype=np.int64) for _ in range(2))

        def watch(left, right, made):
            self.left[made], self.right[made] = left, right     # any string's: they all agree

        ids, owner = self.merge(chars, np.repeat(np.arange(len(texts)), sizes), watch)
        self.own = np.zeros(self.size, bool)
        one = np.bincount(owner, minlength=len(texts)) == 1
        own = ids[one[owner]] == np.array(self.normal)[owner[one[owner]]]
        self.own[ids[one[owner]][own]] = True
        self.plain = ~self.shared | (self.left < 0)     # a single character is not merged at all
        for i in sorted(np.flatnonzero(self.left >= 0), key=lambda i: self.length[i]):
            for part in (self.left[i], self.right[i]):
                self.plain[i] &= self.plain[part] and (self.left[part] < 0 or self.rank[part] < self.rank[i])

    def undone(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Compatible pairs, for pieces whose merges come in rising rank: merges are undone from the
        last to the first, and before each a merge across the boundary must not have come earlier."""
        a, b = a.copy(), b.copy()
        fine = self.joined(a, b)[0] >= NEVER
        live = np.flatnonzero(fine)
        while len(live):
            x, y = a[live], b[live]
            rx = np.where(self.left[x] >= 0, self.rank[x], -1)
            ry = np.where(self.left[y] >= 0, self.rank[y], -1)
            some = np.maximum(rx, ry) >= 0
            live, x, y, rx, ry = live[some], x[some], y[some], rx[some], ry[some]
            right = ry >= rx                        # of equal ranks the right one came last
            x = np.where(right, x, self.right[x])
            y = np.where(right, self.left[y], y)
            ok = self.joined(x, y)[0] > np.where(right, ry, rx - 1)
            fine[live[~ok]] = False
            a[live], b[live] = x, y
            live = live[ok]
        return fine

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The same for any pieces, by merging the joined text."""
        texts = [self.surface[x] + self.surface[y] for x, y in zip(a.tolist(), b.tolist())]
        chars = self.char_id[self.class_of[[ord(x) for t in texts for x in t]]]
        ids, owner = self.merge(chars, np.repeat(np.arange(len(texts)), [len(t) for t in texts]))
        start = np.searchsorted(owner, np.arange(len(texts)))
        two = np.bincount(owner, minlength=len(texts)) == 2
        last = np.minimum(start + 1, len(ids) - 1)
        return two & (ids[start] == a) & (ids[last] == b)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each two pieces: their texts joined are encoded as the two. Remembered in a table of
        fixed size, where a later pair takes the place of an earlier one."""
        key = a * self.size + b
        place = (key * np.int64(0x9E3779B1) >> np.int64(7)) & ((1 << MEMO_BITS) - 1)
        known = self.memo[place]
        out = (known & 1).astype(bool)
        new = np.flatnonzero(known >> 1 != key)
        if len(new):
            keys, back = np.unique(key[new], return_inverse=True)
            x, y = keys // self.size, keys % self.size
            fine = np.zeros(len(keys), bool)
            plain = self.plain[x] & self.plain[y]
            fine[plain] = self.undone(x[plain], y[plain])
            if not plain.all():
                fine[~plain] = self.merged(x[~plain], y[~plain])
            out[new] = fine[back]
            self.memo[place[new]] = key[new] << 1 | out[new]
        return out

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the units on end, and where each unit's begin (one more: the end). A unit is a
        stretch of normalised text that starts and ends where no merge can cross."""
        if not units:
            return np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)
        sizes = np.array([len(u) for u in units], dtype=np.int64)
        text = "\n".join(units) + "\n"          # the automaton starts anew at each unit
        begin = np.cumsum(sizes + 1) - (sizes + 1)
        c = self.class_of[np.frombuffer(text.encode("utf-32-le"), dtype="<u4")]
        n = len(c)
        known = c > 0
        cut = np.ones(n + 1, bool)              # a segment starts here
        cut[1:n] = ~self.beside[c[:-1], c[1:]]
        cut[begin] = True
        cut[begin + sizes] = True
        place = np.arange(n)
        first = np.maximum.accumulate(np.where(cut[:n], place, 0))
        found = np.fromiter(chain.from_iterable(self.automaton.iter(text)), dtype=np.int64)     # end, piece, end, piece
        piece = np.ascontiguousarray(found[1::2])
        number = np.bincount(found[::2], minlength=n)
        here = np.cumsum(number) - number               # longest first among those of one end
        last = np.full(n, -1, dtype=np.int64)
        depth = place - first
        todo = np.flatnonzero(known)
        todo = todo[np.argsort(depth[todo], kind="stable")]
        ends = np.cumsum(np.bincount(depth[todo])) if len(todo) else []
        done = 0
        for stop in ends:
            at = todo[done:stop]
            done, match = stop, here[at]
            while len(at):
                t = piece[match]
                before = at - self.length[t]
                opening = before < first[at]
                prev = last[before]
                ok = opening.copy()
                inner = np.flatnonzero(~opening)
                ok[inner] = self.compatible(prev[inner], t[inner])
                last[at[ok]] = t[ok]
                at, match = at[~ok], match[~ok] + 1
        # backwards from the end of every segment
        e = np.flatnonzero(known & cut[1:])
        keys, ids = [], []
        while len(e):
            t = last[e]
            keys.append(e * 4)
            ids.append(t)
            more = e - self.length[t] >= first[e]
            e = (e - self.length[t])[more]
        strange = np.flatnonzero(~known)
        strange = strange[~np.isin(strange, begin + sizes)]     # not the line ends between units
        for p in strange.tolist():
            raw = text[p].encode()
            keys.append(p * 4 + np.arange(len(raw)))
            ids.append(self.byte_ids[list(raw)])
        keys, ids = np.concatenate(keys), np.concatenate(ids)
        order = np.argsort(keys, kind="stable")
        return ids[order], np.append(np.searchsorted(keys[order], begin * 4), len(ids))

    def surfaces(self, ids: list[int]) -> str:
        """Pieces' texts on end, bytes put together to characters, spaces not yet restored."""
        if self.part.isdisjoint(ids):
            return "".join(map(self.alone.__getitem__, ids))
        out, raw = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                raw.append(b)
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(self.surface[i])
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out)

    def decode(self, ids) -> str:
        return spaced(self.surfaces(ids))

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text, begin and end included."""
        ids, _ = self.encode_units([unit(w) for w in words(text)])
        return np.concatenate([[self.begin], ids, [self.end]])


def words(text: str) -> list[str]:
    """The text cut before every space that follows another character; each word less its first
    space (the text's own first word gets one). No merge crosses these cuts."""
    if SPACE in text:
        text = text.replace(SPACE, " ")
    parts = text.split(" ")
    if "" not in parts:
        return parts
    if not text:
        return []
    out, extra = [], 0
    for p in parts[:-1]:
        if p:
            out.append(" " * extra + p)
            extra = 0
        else:
            extra += 1
    out.append(" " * extra + parts[-1])
    return out


def unit(word: str) -> str:
    return SPACE + word.replace(" ", SPACE)


def spaced(surface: str) -> str:
    return (surface[1:] if surface[:1] == SPACE else surface).replace(SPACE, " ")


class TextPieces:
    """Whole texts. What a word becomes is remembered for at most `limit` words, then forgotten."""

    def __init__(self, path: str, limit: int = 400_000):
        self.pieces, self.limit = Pieces(path), limit
        self.ids: dict[str, bytes] = {}         # ids as little-endian 32-bit numbers
        self.other: dict[str, str] = {}         # words whose ids decode to another text than the word's
        self.begin, self.end = (np.array([i], dtype="<u4").tobytes() for i in (self.pieces.begin, self.pieces.end))

    def _learn(self, new: list[str]):
        units = [unit(w) for w in new]
        for i, j in chunks([len(u) + 1 for u in units], 1_000_000):
            ids, begin = self.pieces.encode_units(units[i:j])
            raw, ids, begin = ids.astype("<u4").tobytes(), ids.tolist(), begin.tolist()
            ends = [4 * b for b in begin]
            self.ids.update(zip(new[i:j], [raw[a:b] for a, b in zip(ends, ends[1:])]))
            if self.pieces.surfaces(ids) != "".join(units[i:j]):
                for w, u, a, b in zip(new[i:j], units[i:j], begin, begin[1:]):
                    if (back := self.pieces.surfaces(ids[a:b])) != u:
                        self.other[w] = back

    def encode_decode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """(ids as little-endian 32-bit numbers with begin and end, decoded text) of each text."""
        collecting = gc.isenabled()
        gc.disable()                            # many small objects, no cycles
        try:
            cut = [words(t) for t in texts]
            distinct = set(chain.from_iterable(cut))
            new = [w for w in distinct if w not in self.ids]
            if len(self.ids) + len(new) > self.limit and self.ids:
                self.ids.clear()
                self.other.clear()
                new = list(distinct)
            self._learn(new)
            return [(b"".join([self.begin, *map(self.ids.__getitem__, ws), self.end]), self._decoded(t, ws))
                    for t, ws in zip(texts, cut)]
        finally:
            if collecting:
                gc.enable()

    def _decoded(self, text: str, ws: list[str]) -> str:
        """Every word's ids have been decoded: where none gives another text than the word's, the
        whole is the text itself."""
        if self.other and not self.other.keys().isdisjoint(ws):
            return spaced("".join([self.other.get(w) or unit(w) for w in ws]))
        return text.replace(SPACE, " ")


@lru_cache(maxsize=2)
def codec(path: str) -> TextPieces:
    return TextPieces(path)


def _coded(df: DataFrame, id_col: str, text_col: str, path: str, row, schema: str) -> DataFrame:
    names = [x.split()[0] for x in schema.split(", ")][1:]

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i, j in chunks([len(t) for t in texts], 2_000_000):
                rows = [row(*x) for x in codec(path).encode_decode(texts[i:j])]
                yield pa.RecordBatch.from_pydict(
                    {id_col: batch.column(0).slice(i, j - i), **{n: [r[k] for r in rows] for k, n in enumerate(names)}})
    return df.select(F.col(id_col).cast("long").alias(id_col),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).mapInArrow(run, schema)


def encode_pieces(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col`, `ids` (array of ids of the whole text, begin and end included), `decoded`.

    Null and empty texts give the begin and the end id and an empty decoded text. One row per input
    row, repeated rows too; an empty table gives no rows; other columns are not read. Characters
    that no piece holds become their UTF-8 bytes' pieces."""
    return _coded(df, id_col, text_col, path, lambda ids, text: (np.frombuffer(ids, dtype="<u4").tolist(), text),
                  f"{id_col} long, ids array<long>, decoded string")


def pieces_digest(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col`, n_tokens, ids_sha256, decoded_sha256 of the same encoding."""
    return _coded(df, id_col, text_col, path,
                  lambda ids, text: (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()),
                  f"{id_col} long, n_tokens long, ids_sha256 string, decoded_sha256 string")
