"""Small helpers shared by the operators: words, 64-bit names, scratch tables, batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import scratch_path

U64 = np.uint64
MASK64 = (1 << 64) - 1


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to a new table in the shared scratch folder and read back: a cut in the
    lineage that survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id) -> F.Column:
    """True for the documents no model may learn from: crc32 of the decimal id, mod 4, is 2."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


SPREAD = 1 << 40


def spread_key(id_col, seed: int = 0) -> F.Column:
    """A fixed pseudo-random number below SPREAD for an id."""
    return F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(SPREAD))


def spread_below(n: int, count) -> F.Column:
    """Only keys below this can be among the n smallest of `count` (eight times over): filtering by
    it first keeps a choice of n rows small however many rows there are."""
    return F.lit(float(SPREAD)) * F.least(F.lit(1.0), F.lit(8.0 * n) / F.greatest(F.lit(1), F.lit(count) if isinstance(count, int) else count))


def word_names(words: list[bytes]) -> np.ndarray:
    """64-bit names of words. Hashing anew is cheaper than looking up a table of a large vocabulary."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=U64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: spreads every input bit over the 64 output bits."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


class Rolling:
    """Names of substrings from prefix sums: name(a, b) depends only on symbols[a:b].

    The sums are polynomials in an odd base modulo 2^64; dividing by base^a (an odd number
    has an inverse) makes the value independent of the place."""

    BASE = 0x9E3779B97F4A7C15
    _pow = np.ones(1, dtype=U64)
    _inv = np.ones(1, dtype=U64)

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        if len(Rolling._pow) <= n:
            size = max(1 << 16, 1 << int(n).bit_length())
            ones = np.ones(size, dtype=U64)
            for attr, base in (("_pow", self.BASE), ("_inv", pow(self.BASE, -1, 1 << 64))):
                steps = ones * U64(base)
                steps[0] = 1
                setattr(Rolling, attr, np.multiply.accumulate(steps))
        self.sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(symbols * Rolling._pow[:n], out=self.sums[1:])

    def name(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mixed((self.sums[b] - self.sums[a]) * Rolling._inv[a])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def chunks(sizes, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges [i, j) of consecutive items whose sizes add up to at most `limit` (one larger
    item forms a range of its own)."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def table_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=schema.field(n).type)
         for n, c in columns.items()], schema=schema)
