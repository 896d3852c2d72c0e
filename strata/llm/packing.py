"""Best-fit packing (operator 8): minimum bin slack over the histogram of piece lengths.

Which pieces share a sequence depends on their lengths alone, and there are at most `capacity`
different lengths. So Spark counts pieces by length, the driver plans on that histogram (at most
`capacity` numbers, whatever the data), and Spark gives each piece its place by its rank among
the pieces of its length.

Planning follows minimum bin slack: a bin takes the longest piece left, then bitset subset-sum
dynamic programming over the lengths still available finds the fullest feasible combination.
As the same combination stays the fullest while the pieces for it last, it is applied as often
as they do; each plan step uses up some length's supply, so steps don't grow with the data.
"""

from __future__ import annotations

import base64
import os
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import chunks, stored

_PLAIN = regex.compile("[^\x00-\u024f]")      # letters, digits and spaces beyond: library only
LONG_RUN = 4000
_LONG_SPACE = regex.compile(r"\p{White_Space}{%d}" % LONG_RUN)


class TokenBytes:
    """Texts -> little-endian 32-bit ids, as the tokenizers library encodes them.

    With the same vocabulary as a rank file, most texts go through tiktoken, which is several
    times faster. The library itself takes the texts on which the two might differ or tiktoken
    is slow: special tokens, characters beyond Latin (other tables of letters), and runs of
    more than LONG_RUN characters without or of white space."""

    def __init__(self, path: str, rank_path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.fast = None
        if rank_path:
            with open(rank_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def plain(self, text: str) -> bool:
        return (self.fast is not None and not _PLAIN.search(text) and not any(s in text for s in self.special)
                and max(map(len, text.split()), default=0) <= LONG_RUN and not _LONG_SPACE.search(text))

    def encode(self, texts: list[str]) -> list[bytes]:
        out = [self.fast.encode_to_numpy(t, disallowed_special=()).astype("<u4").tobytes() if self.plain(t) else None
               for t in texts]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, e in zip(rest, self.library.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)):
            out[i] = np.array(e.ids, dtype="<u4").tobytes()
        return out


@lru_cache(maxsize=2)
def coder_of(path: str, rank_path: str | None) -> TokenBytes:
    return TokenBytes(path, rank_path)


def pieces(df: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
           id_col: str = "doc_id", text_col: str = "text", rank_path: str | None = None) -> DataFrame:
    """`id_col`, piece, start, length, ids_crc32 of every piece, with (part, nth): the task that made
    it and its number among that task's pieces of its length. Only documents over `capacity`
    are cut; then the first piece takes the rest and the others are full."""
    end = end_id.to_bytes(4, "little")

    def run(batches):
        coder, part = coder_of(tokenizer_path, rank_path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i, j in chunks([len(t) for t in texts], 1_000_000):
                rows = []
                for k, ids in enumerate(coder.encode(texts[i:j]), i):
                    ids += end
                    total = len(ids) // 4
                    at, size = 0, (total - 1) % capacity + 1
                    for piece in range(-(-total // capacity)):
                        rows.append((k, piece, at, size, zlib.crc32(ids[4 * at:4 * (at + size)]), part, int(seen[size])))
                        seen[size] += 1
                        at, size = at + size, capacity
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(cols[0])), pa.array(cols[1], pa.int32()),
                     *[pa.array(c, pa.int64()) for c in cols[2:]]],
                    names=[id_col, "piece", "start", "length", "ids_crc32", "part", "nth"])
    return df.select(F.col(id_col).cast("long").alias(id_col),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).mapInArrow(
        run, f"{id_col} long, piece int, start long, length long, ids_crc32 long, part long, nth long")


def fullest(available: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of available lengths with the largest sum of at most `room`. Bit s of `reach`
    says that some combination sums to s."""
    reach, steps, limit = 1, [], (1 << (room + 1)) - 1
    for length in sorted(available, reverse=True):
        if length > room:
            continue
        left, unit = min(available[length], room // length), 1
        while left:                     # 1, 2, 4, ... copies at once
            take = min(unit, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & limit
            left -= take
            unit *= 2
        if reach >> room & 1:
            break
    at, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:        # only with this item
            used[length] = used.get(length, 0) + take
            at -= length * take
    return used


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """[(pieces of each length in a bin, number of such bins)]: minimum bin slack."""
    left, out = {n: c for n, c in histogram.items() if c}, []
    while left:
        first = max(left)
        rest = dict(left)
        rest[first] -= 1
        bin_ = fullest({n: c for n, c in rest.items() if c}, capacity - first)
        bin_[first] = bin_.get(first, 0) + 1
        times = min(left[n] // k for n, k in bin_.items())
        out.append((bin_, times))
        for n, k in bin_.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return out


def places(bins: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """length -> rows (first rank, pieces in a bin, first bin, offset), by first rank."""
    out, next_rank, next_bin = {}, {}, 0
    for bin_, times in bins:
        offset = 0
        for length, k in sorted(bin_.items(), reverse=True):
            rank = next_rank.get(length, 0)
            out.setdefault(length, []).append((rank, k, next_bin, offset))
            next_rank[length] = rank + k * times
            offset += k * length
        next_bin += times
    return {n: np.array(rows, dtype=np.int64) for n, rows in out.items()}


def pack(df: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text", rank_path: str | None = None) -> DataFrame:
    """`id_col`, piece, start, length, ids_crc32, sequence_id, offset of every piece of every row.

    Null and empty texts are the end id alone; repeated rows and ids are packed like any others;
    an empty table gives no rows; other columns are not read. `rank_path`: the same vocabulary as a
    rank file, for speed (`TokenBytes`)."""
    made = stored(pieces(df, tokenizer_path, capacity, end_id, id_col, text_col, rank_path), "packing-pieces")
    per_task = made.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = {r.length: r.n for r in made.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    where = places(plan(histogram, capacity))

    def run(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            seq, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for n in np.unique(length):
                pick = np.flatnonzero(length == n)
                table = where[int(n)]
                row = table[np.searchsorted(table[:, 0], rank[pick], side="right") - 1]
                nth = rank[pick] - row[:, 0]
                seq[pick] = row[:, 2] + nth // row[:, 1]
                offset[pick] = row[:, 3] + nth % row[:, 1] * n
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(seq), pa.array(offset)],
                                             names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return (made.join(base, ["length", "part"])
            .select(id_col, "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"))
            .mapInArrow(run, f"{id_col} long, piece int, start long, length long, ids_crc32 long, "
                             "sequence_id long, offset long"))
