"""Passages that occur more than once, found without moving whole texts or all positions.

Both repeat removers need, for every window of `length` symbols (bytes or words), whether the
same string starts elsewhere. Naming every window would shuffle a row per position. Instead:

1. Winnowing: each window belongs to one *anchor*, the `seed` symbols inside it whose hash is
   smallest (leftmost on ties). The choice depends on the window's content only, so equal
   windows have equal anchors at equal places, and one anchor stands for a run of windows.
2. Anchors whose seed occurs once are dropped. Of the rest, those whose whole run of windows
   has the same surroundings form a class, settled in one step for all members.
3. What is left is refined in rounds. A run of neighbouring windows has a *core* (the symbols
   all of them share) and a *hull* (all symbols of any of them). Spark groups (seed, name)
   pairs: a core that occurs once drops its run, a hull that occurs elsewhere settles it, and
   the others are cut into shorter runs with longer cores until a run is one window.

Rows are anchors and runs, never pairs of occurrences, so a passage held by a third of all
documents costs a row for each occurrence. Names are two 64-bit hashes (seed and string).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Rolling, U64, arrow_schema, chunks, mixed, signed, stored

MAX_RUN = 4095          # a packed place has 12 bits for each distance from the anchor
CHUNK = 1 << 19         # bytes of text handled at once in a task (one longer document alone)
INDEX_BITS = U64(22)    # of a winnowing key, for the place inside a chunk


@dataclass(frozen=True)
class Repeats:
    """length: symbols of a window; seed: symbols of an anchor; steps: run lengths of the
    rounds, descending to 1; symbols: bytes of a document -> uint64 array;
    earlier: a window counts only if it also starts in a smaller doc_id (else anywhere else)."""

    length: int
    seed: int
    steps: tuple[int, ...]
    symbols: Callable[[bytes], np.ndarray]
    earlier: bool

    @property
    def run(self) -> int:
        return self.length - self.seed + 1

    def __post_init__(self):
        if not (0 < self.seed <= self.length and self.run <= MAX_RUN and self.steps[-1] == 1):
            raise ValueError("seed must lie within length, runs within 4095, steps must end in 1")


def packed(p, first, last):
    """An anchor's place and its run of window starts in one long."""
    return (p << 24) | ((p - first) << 12) | (p - last)


def unpacked(x: np.ndarray):
    p = x >> 24
    return p, p - ((x >> 12) & 4095), p - (x & 4095)


def _sliding_min(keys: np.ndarray, w: int) -> np.ndarray:
    """min(keys[i:i+w]) for every i, by prefix and suffix minima of blocks of w."""
    n = len(keys)
    top = np.full(n + (-n) % w, ~U64(0))
    top[:n] = keys
    blocks = top.reshape(-1, w)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - w + 1
    return np.minimum(after[:m], before[w - 1:w - 1 + m])


def anchors_of(symbols: list[np.ndarray], spec: Repeats):
    """Anchors of some documents of at least `length` symbols each, as arrays:
    document number, p, first, last (window starts), seed name, hull name."""
    sizes = np.array([len(s) for s in symbols], dtype=np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    joined = np.concatenate(symbols)
    roll = Rolling(joined)
    k, w, length = spec.seed, spec.run, spec.length
    at = np.arange(len(joined) - k + 1)
    seeds = roll.name(at, at + k)
    bits = INDEX_BITS if len(at) <= 1 << int(INDEX_BITS) else U64(int(len(at)).bit_length())
    low = U64((1 << int(bits)) - 1)
    best = _sliding_min((seeds & ~low) | at.astype(U64), w) & low
    doc = np.repeat(np.arange(len(symbols)), sizes)[:len(best)]
    s = np.flatnonzero(np.arange(len(best)) + length <= ends[doc])
    p, doc = best[s].astype(np.int64), doc[s]
    new = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (doc[1:] != doc[:-1])]))
    first, last = s[new], s[np.concatenate([new[1:] - 1, [len(s) - 1]])]
    p, doc = p[new], doc[new]
    shape = ((p - first) << 12 | (last - first)).astype(U64)
    hull = mixed(roll.name(first, last + length) + shape)
    base = starts[doc]
    return doc, p - base, first - base, last - base, seeds[p], hull


_ANCHORS = pa.schema([("d", pa.int64()), ("t", pa.int64()), ("h", pa.int64()), ("u", pa.int64()),
                      ("at", pa.int64())])


def blocks(symbols: np.ndarray, length: int):
    """(start, symbols) of blocks that hold every window of `length` symbols exactly once. An anchor
    whose run of windows crosses into the next block gives two rows, which is as good as one."""
    for a in range(0, len(symbols) - length + 1, CHUNK):
        yield a, symbols[a:a + CHUNK + length - 1]


def _anchor_rows(spec: Repeats):
    def run(batches):
        for batch in batches:
            d, t = batch.column("d"), batch.column("t")
            b = batch.column("b")
            for lo, hi in chunks(pc.binary_length(b).to_pylist(), CHUNK):
                coded = [(i, spec.symbols(x)) for i, x in enumerate(b.slice(lo, hi - lo).to_pylist(), lo)]
                coded = [(i, a, s) for i, whole in coded for a, s in blocks(whole, spec.length)]
                if not coded:
                    continue
                # one document longer than a chunk: block by block, so memory stays bounded
                groups = [[c] for c in coded] if len(coded) > 1 and hi - lo == 1 else [coded]
                for group in groups:
                    doc, p, first, last, h, u = anchors_of([s for _, _, s in group], spec)
                    base = np.array([a for _, a, _ in group])[doc]
                    p, first, last = p + base, first + base, last + base
                    row = pa.array(np.array([i for i, _, _ in group])[doc])
                    yield pa.RecordBatch.from_arrays(
                        [d.take(row), t.take(row), pa.array(signed(h)), pa.array(signed(u)),
                         pa.array(packed(p, first, last))], schema=_ANCHORS)
    return run


_NAMES = pa.schema([("d", pa.int64()), ("t", pa.int64()), ("h", pa.int64()), ("u", pa.int64()),
                    ("at", pa.int64()), ("hull", pa.bool_())])


def names_of(symbols: np.ndarray, places: np.ndarray, step: int, spec: Repeats):
    """Cores and hulls of the runs of `step` windows that make up the given runs of one document:
    arrays seed name, name, packed place, is-hull."""
    p, first, last = unpacked(places)
    roll = Rolling(symbols)
    lo, hi = p - last, p - first                      # distances of the windows from the anchor
    count = hi // step - lo // step + 1
    pick = np.repeat(np.arange(len(p)), count)
    cell = np.arange(len(pick)) - np.repeat(np.cumsum(count) - count, count) + (lo // step)[pick]
    near, far = cell * step, np.minimum(cell * step + step, spec.run) - 1
    lo, hi, p = lo[pick], hi[pick], p[pick]
    whole = (near >= lo) & (far <= hi)
    at = packed(p, p - np.minimum(far, hi), p - np.maximum(near, lo))
    h = roll.name(p, p + spec.seed)
    mark = (cell * MAX_RUN + step).astype(U64)
    hull = mixed(roll.name((p - far)[whole], (p - near)[whole] + spec.length) + mark[whole])
    if step == 1:
        return h[whole], hull, at[whole], np.ones(whole.sum(), bool)
    core = mixed(roll.name(p - near, p - far + spec.length) ^ ~mark)
    return (np.concatenate([h, h[whole]]), np.concatenate([core, hull]), np.concatenate([at, at[whole]]),
            np.concatenate([np.zeros(len(at), bool), np.ones(whole.sum(), bool)]))


def _name_rows(spec: Repeats, step: int):
    def run(batches):
        for batch in batches:
            d, t = batch.column("d"), batch.column("t")
            active = batch.column("active").to_pylist()
            out, size = [], 0
            for i, b in enumerate(batch.column("b").to_pylist()):
                out.append((i, *names_of(spec.symbols(b), np.array(active[i], dtype=np.int64), step, spec)))
                size += len(out[-1][1])
                if size >= CHUNK // 4 or i == batch.num_rows - 1:
                    row = pa.array(np.repeat([o[0] for o in out], [len(o[1]) for o in out]))
                    h, u, at, hull = (np.concatenate([o[j] for o in out]) for j in (1, 2, 3, 4))
                    yield pa.RecordBatch.from_arrays(
                        [d.take(row), t.take(row), pa.array(signed(h)), pa.array(signed(u)),
                         pa.array(at), pa.array(hull)], schema=_NAMES)
                    out, size = [], 0
    return run


def merged(covered: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs [start, end) covered by the windows of packed places."""
    if not len(covered):
        return []
    _, first, last = unpacked(covered)
    order = np.argsort(first, kind="stable")
    start, end = first[order], np.maximum.accumulate(last[order] + length)
    new = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
    return list(zip(start[new].tolist(), end[np.concatenate([new[1:] - 1, [len(end) - 1]])].tolist()))


def _settle(spec: Repeats, project, keep: list[str], schema: T.StructType):
    """Rows whose documents have no open runs get their results; the others stay open."""
    out = arrow_schema(schema)
    fields = [f.name for f in schema.fields[len(keep):-5]]

    def run(batches):
        for batch in batches:
            kept = [batch.column(c) for c in keep]
            texts = batch.column("b").to_pylist()
            covered, active = (batch.column(c).to_pylist() for c in ("covered", "active"))
            values = [None if a else project(b, merged(np.array(c or [], dtype=np.int64), spec.length))
                      for b, c, a in zip(texts, covered, active)]
            cols = [pa.array([None if v is None else v[j] for v in values], type=out.field(f).type)
                    for j, f in enumerate(fields)]
            is_open = [bool(a) for a in active]
            cols += [pa.array([x if o else None for x, o in zip(xs, is_open)], type=out.field(f).type)
                     for f, xs in (("d", batch.column("d").to_pylist()), ("t", batch.column("t").to_pylist()),
                                   ("b", texts), ("covered", covered), ("active", active))]
            yield pa.RecordBatch.from_arrays([*kept, *cols], schema=out)
    return run


def _who(spec: Repeats, at: str = "at"):
    """The occurrence a row stands for: its document's id, or (document, place)."""
    if spec.earlier:
        return F.coalesce("d", F.lit(-(1 << 63)))
    return F.xxhash64("d", "t", F.shiftright(at, 24))


def apply_repeats(docs: DataFrame, spec: Repeats, project, fields: list[T.StructField],
                  keep: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`keep` columns of every row of `docs`, then `fields` from project(text bytes, spans),
    where spans are the maximal [start, end) runs of symbols that repeated windows cover.

    Nulls: a null text is empty; a null id counts as the smallest. Rows with the same id and
    text are one document and get equal results; the same id with other texts is another
    document. Input columns outside `keep` are dropped, so clashing names do no harm."""
    # internal names cannot clash: kept columns are renamed while the work goes on
    inner = [f"keep_{i}" for i in range(len(keep))]
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    src = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, inner)], F.col(id_col).cast("long").alias("d"),
                      F.xxhash64(text).alias("t"), text.alias("b"))
    same = F.col("s.d").eqNullSafe(F.col("m.d")) & (F.col("s.t") == F.col("m.t"))

    # 1-2: anchors, seeds that occur more than once, classes of equal surroundings
    def anchors():
        rows = src.select("d", "t", "b").mapInArrow(_anchor_rows(spec), "d long, t long, h long, u long, at long")
        return rows.withColumn("o", _who(spec))

    # what joins onto rows is a table of its own, not an aggregate over the same exchange: only
    # then can adaptive execution split a seed, class or name that very many rows share
    seeds = stored(anchors().groupBy("h").agg(F.min("o").alias("lo"), F.max("o").alias("hi"),
                                              F.min("u").alias("u0"), F.max("u").alias("u1"))
                   .where("lo <> hi").select("h", F.expr("u0 <> u1").alias("mixed"), F.col("lo").alias("seed_lo")),
                   "repeat-seeds")
    shared = stored(anchors().join(seeds, "h"), "repeat-anchors")
    uniform = shared.where("not mixed").select(
        "d", "t", "at", (F.col("seed_lo") < F.col("o") if spec.earlier else F.lit(True)).alias("cov"),
        F.lit(False).alias("act"))
    split = shared.where("mixed")
    classes = stored(split.groupBy("h", "u").agg(F.min("o").alias("lo"), F.max("o").alias("hi")), "repeat-classes")
    in_class = split.join(classes, ["h", "u"]).select(
        "d", "t", "at", F.expr("lo < o" if spec.earlier else "lo <> hi").alias("cov"),
        F.expr("o = lo").alias("act"))

    def by_doc(rows):
        return (rows.where("cov or act").groupBy("d", "t")
                .agg(F.expr("collect_list(case when cov then at end)").alias("covered"),
                     F.expr("collect_list(case when act then at end)").alias("active")))

    state = T.StructType([
        *[T.StructField(n, docs.schema[c].dataType) for c, n in zip(keep, inner)],
        *[T.StructField(f.name, f.dataType) for f in fields],
        T.StructField("d", T.LongType()), T.StructField("t", T.LongType()), T.StructField("b", T.BinaryType()),
        T.StructField("covered", T.ArrayType(T.LongType())), T.StructField("active", T.ArrayType(T.LongType()))])

    def settled(rows, name):
        return stored(rows.mapInArrow(_settle(spec, project, inner, state), state), name)

    def empty(c):
        return F.coalesce(c, F.array().cast("array<bigint>"))

    marks = by_doc(uniform.unionByName(in_class))
    tables = [settled(
        src.alias("s").join(marks.alias("m"), same, "left")
        .select(*[F.col(f"s.{c}") for c in [*inner, "d", "t", "b"]],
                empty(F.col("m.covered")).alias("covered"), empty(F.col("m.active")).alias("active")), "repeat-0")]

    # 3: rounds over the documents that still have open runs
    for step in spec.steps:
        still = tables[-1].where("b is not null").select(*inner, "d", "t", "b", "covered", "active")

        def named(still=still, step=step):
            rows = still.select("d", "t", "b", "active").mapInArrow(
                _name_rows(spec, step), "d long, t long, h long, u long, at long, hull boolean")
            return rows.withColumn("o", _who(spec))

        twice = stored(named().groupBy("h", "u").agg(F.min("o").alias("lo"), F.max("o").alias("hi"))
                       .where("lo <> hi"), "repeat-names")
        runs = (named().join(twice, ["h", "u"]).groupBy("d", "t", "at")
                .agg(F.max(F.expr("hull and lo < o" if spec.earlier else "hull")).alias("cov"),
                     F.max(F.expr("not hull")).alias("core"),
                     F.max(F.expr("hull and lo <> o")).alias("told"))
                .select("d", "t", "at", "cov", F.expr("core and not told").alias("act")))
        marks = by_doc(runs)
        tables.append(settled(
            still.alias("s").join(marks.alias("m"), same, "left")
            .select(*[F.col(f"s.{c}") for c in [*inner, "d", "t", "b"]],
                    F.concat("s.covered", empty(F.col("m.covered"))).alias("covered"),
                    empty(F.col("m.active")).alias("active")), f"repeat-run{step}"))

    result = None
    for t in tables:
        part = t.where("b is null").select(*[F.col(n).alias(c) for c, n in zip(keep, inner)],
                                           *[f.name for f in fields])
        result = part if result is None else result.unionByName(part)
    return result
