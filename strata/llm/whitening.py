"""Embedding whitening (operator 13): spectrum slicing.

Spark makes the exact sums and the covariance of the distinct vectors. Of the covariance V, a
matrix as wide as a vector, the leading eigenvalues are found by slicing the spectrum: V - s I is
factorised as L D L^T, and the number of positive eigenvalues of D is the number of eigenvalues
of V above s (Sylvester). Halving by these counts isolates each eigenvalue, Rayleigh quotient
iteration started inside its interval converges cubically, and two more counts just above and
below the result certify its number.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Fixed value: vectors become whole numbers of this many to the unit.
STEPS = 256.0


def factor_blocks(a: np.ndarray) -> list[np.ndarray]:
    """The blocks of D (1 x 1 or 2 x 2) of a pivoted L D L^T factorisation of the symmetric `a`."""
    a, out = a.copy(), []
    share = (1 + 17 ** 0.5) / 8                     # keeps the growth of either kind of step alike
    while (n := len(a)) > 0:
        off = np.abs(a)
        diagonal = off.diagonal().copy()
        np.fill_diagonal(off, 0)
        p = int(diagonal.argmax())
        r, c = divmod(int(off.argmax()), n)
        if n == 1 or diagonal[p] >= share * off[r, c]:
            block = [p]
        else:
            block = [r, c]
        rest = np.setdiff1d(np.arange(n), block)
        d = a[np.ix_(block, block)]
        out.append(d)
        if not d.any():                             # nothing but zeros is left
            out += [np.zeros((1, 1))] * (n - 1)
            break
        e = a[np.ix_(rest, block)]
        a = a[np.ix_(rest, rest)] - e @ np.linalg.solve(d, e.T)
        a = (a + a.T) / 2
    return out


def count_above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric `v` lie above `shift`."""
    total = 0
    for d in factor_blocks(v - shift * np.eye(len(v))):
        if len(d) == 1:
            total += d[0, 0] > 0
        else:
            total += 1 if d[0, 0] * d[1, 1] < d[0, 1] ** 2 else 2 * (d[0, 0] + d[1, 1] > 0)
    return int(total)


@dataclass(frozen=True)
class Slice:
    """One eigenvalue: its vector, and the numbers of eigenvalues found above value + margin and
    above value - margin (number - 1 and at least `number` where the numbering is certain)."""

    value: float
    vector: np.ndarray
    above_upper: int
    above_lower: int


def _quotient_iteration(v: np.ndarray, lo: float, hi: float, found: list[np.ndarray]) -> tuple[float, np.ndarray]:
    """An eigenvalue of `v` within [lo, hi] and its vector, across the vectors already found."""
    n = len(v)
    basis = np.array(found).reshape(len(found), n)
    away = lambda x: x - basis.T @ (basis @ x)
    size = np.abs(v).max() or 1.0
    best = None
    for start in range(n):                          # the first start nearly always does
        x = away(np.cos(np.arange(n) * (start + 1.0)) + np.eye(n)[start])
        shift = (lo + hi) / 2
        for step in range(60):
            if not (length := np.linalg.norm(x)) > 0:
                break
            x = x / length
            if step >= 3:                           # after inverse iteration at the interval's middle
                shift = float(np.clip(x @ v @ x, lo, hi))
            if step and np.linalg.norm(away(v @ x - (x @ v @ x) * x)) <= 4e-15 * n * size:
                break
            y, nudge = None, 0.0
            while y is None:
                try:
                    y = np.linalg.solve(v - (shift + nudge) * np.eye(n), x)
                except np.linalg.LinAlgError:       # the shift is an eigenvalue to the last bit
                    nudge = max(1e-15 * size, 4 * nudge)    # the first may be lost in a far larger shift
            x = away(away(y / np.linalg.norm(y)))
        else:
            x = x / np.linalg.norm(x)
        value = float(x @ v @ x)
        off = np.linalg.norm(v @ x - value * x) + max(lo - value, value - hi, 0.0)
        if best is None or off < best[0]:
            best = off, value, x
        if off <= 1e-13 * n * size:
            break
    return best[1], best[2]


def leading(v: np.ndarray, count: int) -> list[Slice]:
    """The `count` largest eigenvalues of the symmetric, non-negative `v` with unit vectors, largest
    first. Eigenvalues that are zero up to rounding are left out."""
    n = len(v)
    top = float(np.abs(v).sum(axis=1).max()) if n else 0.0       # no eigenvalue is larger
    least = 4 * n * np.finfo(float).eps * top
    if not top > 0:
        return []
    out: list[Slice] = []
    have = count_above(v, least)
    for number in range(1, min(count, have) + 1):
        lo, hi = least, top * (1 + 1e-12)           # more than number - 1 above lo, at most that above hi
        above_lo, above_hi = have, 0
        while hi - lo > 64 * n * np.finfo(float).eps * top:
            if above_lo == number and above_hi == number - 1 and hi - lo < 1e-4 * top:
                break                               # isolated; equal ones never are
            middle = (lo + hi) / 2
            if (k := count_above(v, middle)) >= number:
                lo, above_lo = middle, k
            else:
                hi, above_hi = middle, k
        value, x = _quotient_iteration(v, lo, hi, [s.vector for s in out])
        margin = max(1e-12 * top, 256 * n * np.finfo(float).eps * top)
        s = Slice(value, x, count_above(v, value + margin), count_above(v, value - margin))
        if s.above_upper >= number or s.above_lower < number:
            raise ArithmeticError(f"eigenvalue {number} is not numbered for certain")
        out.append(s)
    return out


@dataclass(frozen=True)
class Whitening:
    """What is learnt from the distinct vectors: their number, their sums (exact), the leading
    eigenvalues with their vectors, and the trace of the covariance."""

    n: int
    sums: list[int]
    slices: list[Slice]
    trace: float


def whole(vector) -> F.Column:
    """floor(256 c) of every entry, as long (the nearest long, beyond its range); null for a vector
    that is null or holds a null or non-finite entry."""
    c = vector.cast("array<double>")
    fine = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(vector.isNotNull() & fine, F.transform(c, lambda x: F.floor(x * STEPS)))


def _numbers(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _entries(schema: str, width: int, names: list[str], add):
    """Sums over a task's rows: add(x) -> dict of arrays for a block of vectors; one row per entry."""
    def run(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            x = _numbers(batch.column("x"), width)
            for i in range(0, len(x), 4096):
                for k, y in add(x[i:i + 4096]).items():
                    total[k] = total[k] + y if k in total else y
        if total:
            flat = {k: y.reshape(-1) for k, y in total.items()}
            yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(len(next(iter(flat.values()))), dtype=np.int64)),
                                              **{k: flat[k] for k in names}})
    return run, schema


def _summed(df: DataFrame, width: int, names: list[str], kinds: list[str], add) -> dict[str, list]:
    """Entry sums over all rows of `df`: as many as `add` gives, whatever the number of rows."""
    schema = ", ".join(["i long", *[f"{n} {k}" for n, k in zip(names, kinds)]])
    run, schema = _entries(schema, width, names, add)
    # long sums go on as decimals, so no total runs over
    rows = (df.select("x").mapInArrow(run, schema).groupBy("i")
            .agg(*[F.sum(F.col(n).cast("decimal(38,0)") if k == "long" else F.col(n)).alias(n) for n, k in zip(names, kinds)])
            .orderBy("i").collect())
    return {n: [r[n] for r in rows] for n in names}


def learn(fit: DataFrame, width: int, components: int) -> Whitening | None:
    """`fit`: one column x, each distinct vector once. None for an empty table."""
    # in two halves of 32 bits, whose sums fit whatever the numbers
    got = _summed(fit, width, ["high", "low", "n"], ["long"] * 3,
                  lambda x: {"high": (x >> 32).sum(axis=0), "low": (x & 0xFFFFFFFF).sum(axis=0),
                             "n": np.full(width, len(x), dtype=np.int64)})
    if not got["n"]:
        return None
    n, sums = int(got["n"][0]), [int(a) * 2 ** 32 + int(b) for a, b in zip(got["high"], got["low"])]
    mean = np.array([s / n for s in sums])

    def products(x):
        c = x - mean
        return {"v": (c.T @ c) / n}
    v = np.array(_summed(fit, width, ["v"], ["double"], products)["v"]).reshape(width, width)
    v = (v + v.T) / 2
    return Whitening(n, sums, leading(v, components), float(np.trace(v)))


def _projection(model: Whitening):
    mean = np.array([s / model.n for s in model.sums])
    axes = np.array([s.vector / s.value ** 0.5 for s in model.slices]).T
    return lambda x: (x - mean) @ axes


def identity_error(fit: DataFrame, width: int, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance, measured over all of them, minus
    the identity."""
    project, k = _projection(model), len(model.slices)
    middle = np.array(_summed(fit, width, ["m"], ["double"], lambda x: {"m": project(x).sum(axis=0) / model.n})["m"])

    def products(x):
        w = project(x) - middle
        return {"v": (w.T @ w) / model.n}
    v = np.array(_summed(fit, width, ["v"], ["double"], products)["v"]).reshape(k, k)
    return float(np.abs(v - np.eye(k)).max())


def whiten(df: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """`id_col`, component (from 1), n, deviation, whitened, explained and identity_error: a row for
    each remaining row of `df` and each of the `components` leading components (fewer where the
    covariance has a lower rank; none if all vectors are equal).

    Rows whose vector is null or holds null or non-finite entries give no rows; nor do empty
    vectors, and vectors of another length than the commonest (of equally common ones the longest).
    Repeated rows each give their rows, while every distinct vector counts once in the fit; an
    empty table gives no rows; other columns are not read. `deviation` is exact; one beyond a
    64-bit number is null."""
    out = f"{id_col} long, component int, n long, deviation decimal(38,0), whitened double"
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), whole(F.col(vector_col)).alias("x")) \
        .where(F.col("x").isNotNull() & (F.size("x") > 0))
    widths = rows.groupBy(F.size("x").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).limit(1).collect()
    width = widths[0]["w"] if widths else 1
    rows = rows.where(F.size("x") == width)
    fit = stored(rows.select("x").distinct(), "whitening-fit")
    model = learn(fit, width, components)
    if model is None or not model.slices:
        return spark.createDataFrame([], f"{id_col} long, component int, n long, deviation long, whitened double, "
                                         "explained double, identity_error double")
    error = identity_error(fit, width, model)
    project, n, k = _projection(model), model.n, len(model.slices)
    # n x - S stays below 2^63, and so does the sum of its squares, unless the numbers are huge
    largest = 2 ** 31 / max(width, 1) ** 0.5

    def run(batches):
        sums = np.array(model.sums, dtype=object)
        for batch in batches:
            x = _numbers(batch.column("x"), width)
            wide = n * x.astype(float) - sums.astype(float)
            if np.abs(wide).max(initial=0) < largest:
                d = n * x - sums.astype(np.int64)
                deviation = (d * d).sum(axis=1).tolist()
            else:
                deviation = [sum(int(y) ** 2 for y in n * r.astype(object) - sums) for r in x]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(np.repeat(np.arange(len(x)), k))),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(x) * k, n, dtype=np.int64)),
                 pa.array([y if y < 10 ** 38 else None for y in deviation for _ in range(k)], type=pa.decimal128(38, 0)),
                 pa.array(project(x).reshape(-1))], names=[id_col, "component", "n", "deviation", "whitened"])

    explained = F.element_at(F.array(*[F.lit(s.value / model.trace) for s in model.slices]), F.col("component"))
    return rows.mapInArrow(run, out).select(
        id_col, "component", "n", F.col("deviation").try_cast("long").alias("deviation"), "whitened",
        explained.alias("explained"), F.lit(error).alias("identity_error"))
