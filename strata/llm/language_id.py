"""Language ID (operator 1): a bidirectional gated recurrent network over bytes.

Two GRUs of HIDDEN units read a segment of bytes, one from each end; at every byte a softmax over
both states gives language probabilities. A document's probabilities are the mean over all its
bytes. The network is trained here in numpy by backpropagation through time (`Network.gradients`)
with Adam, on segments of at most TRAIN_DOCS documents of each language; every byte of every
whole text is labelled when predicting. Segments of SEGMENT bytes are read side by side, so a
step is one small matrix product for thousands of segments.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, held_out, spread_below, spread_key

HIDDEN, SEGMENT, TRAIN_DOCS, STEPS = 16, 128, 400, 900
_LETTER = regex.compile(r"\p{L}")


class Direction:
    """One GRU. Arrays are [unit, sequence], so each gate is a contiguous block of rows:
    z (keep), r (reset), n (new). `table` holds the input part of every byte."""

    def __init__(self, table: np.ndarray, w: np.ndarray):
        self.table, self.w = table, w           # [3H, 256], [3H, H]

    def run(self, bytes_: np.ndarray, keep: bool = False):
        """States [T, H, B] for bytes [T, B]; with `keep`, what the backward pass needs too."""
        t_max, b = bytes_.shape
        h = self.w.shape[1]
        out = np.empty((t_max, h, b), dtype=np.float32)
        state = np.zeros((h, b), dtype=np.float32)
        cache = []
        gate = np.empty((2 * h, b), dtype=np.float32)
        x = np.empty((3 * h, b), dtype=np.float32)
        new = np.empty((h, b), dtype=np.float32)
        for t in range(t_max):
            np.take(self.table, bytes_[t], axis=1, out=x, mode="clip")
            if keep:
                gate, new = np.empty_like(gate), np.empty_like(new)
            # sigmoid(v) = (1 + tanh(v / 2)) / 2; table and w hold v / 2 for the two gates
            np.dot(self.w[:2 * h], state, out=gate)
            gate += x[:2 * h]
            np.tanh(gate, out=gate)
            gate += 1
            gate *= 0.5
            reset = gate[h:] * state
            np.dot(self.w[2 * h:], reset, out=new)
            new += x[2 * h:]
            np.tanh(new, out=new)
            before = state
            state = out[t]
            np.subtract(before, new, out=state)
            state *= gate[:h]
            state += new                        # z * before + (1 - z) * new
            if keep:
                cache.append((before, gate, new, reset))
        return out, cache

    def back(self, bytes_: np.ndarray, cache, d_out: np.ndarray):
        """Gradients of (table, w) from those of the states."""
        t_max, h, b = d_out.shape
        d_table, d_w = np.zeros_like(self.table), np.zeros_like(self.w)
        d_state = np.zeros((h, b), dtype=np.float32)
        for t in range(t_max - 1, -1, -1):
            before, gate, new, reset = cache[t]
            z, r = gate[:h], gate[h:]
            d = d_out[t] + d_state
            d_pre = np.empty((3 * h, b), dtype=np.float32)
            d_new = d_pre[2 * h:]
            d_new[:] = d * (1 - z) * (1 - new * new)
            d_reset = self.w[2 * h:].T @ d_new
            d_pre[:h] = d * (before - new) * z * (1 - z) * 2        # of the halved sums
            d_pre[h:2 * h] = d_reset * before * r * (1 - r) * 2
            d_state = d * z + d_reset * r + self.w[:2 * h].T @ d_pre[:2 * h]
            d_w[:2 * h] += d_pre[:2 * h] @ before.T
            d_w[2 * h:] += d_new @ reset.T
            np.add.at(d_table.T, bytes_[t], d_pre.T)
        return d_table, d_w


class Network:
    """Forward and backward GRU and a softmax over their states at every byte."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 3):
        r = np.random.default_rng(seed)
        self.languages = languages
        draw = lambda *shape, scale: (r.standard_normal(shape) * scale).astype(np.float32)
        self.p = {}
        for side in ("f", "b"):
            self.p[f"table_{side}"] = draw(3 * hidden, 256, scale=0.3)
            self.p[f"w_{side}"] = draw(3 * hidden, hidden, scale=0.3)
        self.p["out"] = draw(len(languages), 2 * hidden, scale=0.3)
        self.p["bias"] = np.zeros((len(languages), 1), dtype=np.float32)

    def _sides(self):
        return Direction(self.p["table_f"], self.p["w_f"]), Direction(self.p["table_b"], self.p["w_b"])

    @staticmethod
    def _softmax(v: np.ndarray) -> np.ndarray:
        v -= v.max(axis=1, keepdims=True)
        np.exp(v, out=v)
        v /= v.sum(axis=1, keepdims=True)
        return v

    def probabilities(self, bytes_: np.ndarray, length: np.ndarray | None = None) -> np.ndarray:
        """[T, language, B] at every position of the segments [T, B]; those at and after a segment's
        `length` mean nothing. The backward unit reads each segment from its own last byte, so
        what a segment gives does not depend on the segments beside it."""
        front, rear = self._sides()
        h = self.p["w_f"].shape[1]
        v = np.matmul(self.p["out"][:, :h], front.run(bytes_)[0])
        t_max, b = bytes_.shape
        short = np.flatnonzero(length < t_max) if length is not None else []
        turned = bytes_[::-1]
        if len(short):
            turn = np.maximum(length[short] - 1 - np.arange(t_max)[:, None], 0)
            turned = turned.copy()
            turned[:, short] = bytes_[turn, short]
        u = np.matmul(self.p["out"][:, h:], rear.run(turned)[0])
        if len(short):
            own = np.take_along_axis(u[:, :, short], turn[:, None, :], axis=0)
            u = u[::-1].copy()
            u[:, :, short] = own
        else:
            u = u[::-1]
        v += u
        v += self.p["bias"]
        return self._softmax(v)

    def gradients(self, bytes_: np.ndarray, label: np.ndarray):
        """(mean cross-entropy over all positions, gradients) by backpropagation through time."""
        t_max, b = bytes_.shape
        front, rear = self._sides()
        h = self.p["w_f"].shape[1]
        (sf, cf), (sb, cb) = front.run(bytes_, keep=True), rear.run(bytes_[::-1], keep=True)
        states = np.concatenate([sf, sb[::-1]], axis=1)
        p = self._softmax(np.matmul(self.p["out"], states) + self.p["bias"])
        at = (slice(None), label, np.arange(b))
        loss = float(-np.log(np.maximum(p[at], 1e-12)).mean())
        d = p
        d[at] -= 1
        d /= t_max * b
        g = {"out": np.einsum("tlb,thb->lh", d, states, optimize=True), "bias": d.sum(axis=(0, 2))[:, None]}
        d_states = np.matmul(self.p["out"].T, d)
        g["table_f"], g["w_f"] = front.back(bytes_, cf, d_states[:, :h])
        g["table_b"], g["w_b"] = rear.back(bytes_[::-1], cb, d_states[::-1, h:])
        return loss, g

    def fit(self, texts: list[bytes], label: np.ndarray, steps: int = STEPS, batch: int = 128, length: int = 48,
            rate: float = 0.02, seed: int = 5) -> list[float]:
        """Adam on random segments, languages drawn evenly; returns the losses."""
        r = np.random.default_rng(seed)
        by_language = [[t for t, y in zip(texts, label) if y == k and t] for k in range(len(self.languages))]
        by_language = [(k, ts) for k, ts in enumerate(by_language) if ts]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses = []
        for step in range(1, steps + 1):
            rows, y = np.empty((batch, length), dtype=np.uint8), np.empty(batch, dtype=np.int64)
            for i in range(batch):
                k, ts = by_language[i % len(by_language)]
                t = ts[r.integers(len(ts))]
                a = r.integers(max(1, len(t) - length + 1))
                piece = np.frombuffer(t[a:a + length], dtype=np.uint8)
                rows[i], y[i] = np.resize(piece, length), k
            loss, g = self.gradients(np.ascontiguousarray(rows.T), y)
            losses.append(loss)
            now = rate * min(1.0, 2 * (1 - (step - 1) / steps))
            for k, v in self.p.items():
                m[k] += 0.1 * (g[k] - m[k])
                s[k] += 0.01 * (g[k] * g[k] - s[k])
                v -= now * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.99 ** step)) + 1e-8)
        return losses

    def pooled(self, texts: list[bytes], side_by_side: int = 2048) -> np.ndarray:
        """[text, language]: mean probabilities over all bytes; zeros for an empty text."""
        total = np.zeros((len(texts), len(self.languages)))
        size = np.array([len(t) for t in texts], dtype=np.int64)
        joined = np.frombuffer(b"".join(texts), dtype=np.uint8)
        pieces = -(-size // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = (np.cumsum(size) - size)[owner] + nth * SEGMENT
        length = np.minimum(SEGMENT, size[owner] - nth * SEGMENT)
        order = np.argsort(-length, kind="stable")
        for i in range(0, len(order), side_by_side):
            pick = order[i:i + side_by_side]
            width = int(length[pick[0]])
            at = np.arange(width)[:, None]
            # a shorter segment is padded with its own last byte; padded places don't count
            p = self.probabilities(joined[start[pick] + np.minimum(at, length[pick] - 1)], length[pick])
            if length[pick[-1]] < width:
                p *= (at < length[pick])[:, None, :]
            np.add.at(total, owner[pick], p.sum(axis=0).T)
        return total / np.maximum(size, 1)[:, None]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          docs_per_language: int = TRAIN_DOCS) -> Network | None:
    """Learns from text and non-null language of documents that are not held out: at most
    `docs_per_language` of each, chosen by a hash of the id. None if there are none."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))
                       & (F.length(text_col) > 0))
    share = {r.y: r.n for r in known.groupBy(F.col(lang_col).cast("string").alias("y")).agg(F.count("*").alias("n")).collect()}
    if not share:
        return None                     # a row per language
    count = F.create_map(*[F.lit(x) for kv in share.items() for x in kv])[F.col("y")]
    key = known.select(F.col(id_col).alias("d"), F.col(lang_col).cast("string").alias("y")).withColumn("key", spread_key(F.col("d")))
    by = Window.partitionBy("y").orderBy("key", "d")
    ids = (key.where(F.col("key") < spread_below(docs_per_language, count)).withColumn("nth", F.row_number().over(by))
           .where(F.col("nth") <= docs_per_language).select("d").distinct())
    found = (known.join(F.broadcast(ids), F.col("d") == F.col(id_col), "left_semi")     # bounded above
             .select(F.col(id_col).alias("d"), F.col(lang_col).cast("string").alias("y"),
                     F.col(text_col).cast("binary").alias("b")).toArrow())
    rows = sorted(zip(found["d"].to_pylist(), found["y"].to_pylist(), found["b"].to_pylist()))
    if not rows:
        return None
    languages = sorted({y for _, y, _ in rows})
    network = Network(languages)
    network.fit([b for _, _, b in rows], np.array([languages.index(y) for _, y, _ in rows]))
    # training drew languages evenly; the bias takes them back to their shares of the corpus
    n = np.array([share.get(x, 1) for x in languages], dtype=np.float32)
    network.p["bias"] += np.log(n / n.mean())[:, None]
    return network


def predict(docs: DataFrame, network: Network | None, keep: list[str] | None = None, id_col: str = "doc_id",
            text_col: str = "text", out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """`keep` columns (by default the id), and as `out` the predicted language and the mean probability
    of that language, of every row. `und` with score 0 where the text is null or has no letter, or nothing was learnt."""
    keep = keep or [id_col]
    names = [f"in_{i}" for i in range(len(keep))]
    src = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)],
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, j in chunks([len(t) for t in texts], 400_000):
                part = texts[i:j]
                lettered = [k for k, t in enumerate(part) if network and _LETTER.search(t)]
                lang, score = ["und"] * len(part), np.zeros(len(part))
                if lettered:
                    p = network.pooled([part[k].encode() for k in lettered])
                    for k, row in zip(lettered, p):
                        best = int(row.argmax())
                        lang[k], score[k] = network.languages[best], min(1.0, float(row[best]))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(n).slice(i, j - i) for n in names], pa.array(lang, pa.string()), pa.array(score)],
                    names=[*names, "lang_pred", "score"])

    schema = T.StructType([*src.schema.fields[:-1], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return src.mapInArrow(run, schema).select(*[F.col(n).alias(c) for c, n in zip(keep, names)],
                                              F.col("lang_pred").alias(out[0]), F.col("score").alias(out[1]))
