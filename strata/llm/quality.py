"""Quality classifier (operator 9): how much better a text compresses with good text than with bad.

Two zstandard dictionaries are built from texts labelled 1 and 0. A text is cut into blocks of
BLOCK bytes (so that the dictionary, not the text's own history, does the explaining); the
difference of the two compressed sizes, divided by the text's length, goes through a logistic
curve fitted on other labelled texts; the curve's slope and offset depend on exp(-length / SHORT),
because in a short text the difference says less. The fit uses at most DICTIONARY_DOCS texts of each label
and CALIBRATION_DOCS further ones, chosen by a hash of their id; scoring reads every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, spread_below, spread_key

DICTIONARY_DOCS, CALIBRATION_DOCS = 1000, 4000
DICTIONARY_BYTES, BLOCK, LEVEL, SHORT = 112_640, 1024, 3, 150.0


def blocks(text: bytes) -> list[bytes]:
    return [text[i:i + BLOCK] for i in range(0, len(text), BLOCK)]


def dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; plain text itself where there is too little of it to train on."""
    samples = [b for t in texts for b in blocks(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[:DICTIONARY_BYTES]


def compressor(dictionary_bytes: bytes) -> zstandard.ZstdCompressor:
    data = None
    if len(dictionary_bytes) >= 8:
        data = zstandard.ZstdCompressionDict(dictionary_bytes)
        data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False,
                                    write_checksum=False, write_dict_id=False)


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: tuple = (0.0, 0.0, 0.0, 0.0)     # of features() and the constant
    _pair: tuple = field(default=(), repr=False, compare=False)

    def __getstate__(self):
        return {**self.__dict__, "_pair": ()}       # compressors are made anew in each worker

    def difference(self, text: bytes) -> float:
        """(bytes with the bad dictionary - bytes with the good one) per byte of text."""
        if not text:
            return 0.0
        if not self._pair:
            self._pair = (compressor(self.good), compressor(self.bad))
        good, bad = self._pair
        parts = blocks(text)
        return (sum(len(bad.compress(b)) for b in parts) - sum(len(good.compress(b)) for b in parts)) / len(text)

    def features(self, texts: list[bytes]) -> np.ndarray:
        """Difference, shortness and their product, a row per text."""
        x = np.array([self.difference(t) for t in texts])
        short = np.exp(-np.array([len(t) for t in texts]) / SHORT)
        return np.stack([x, short, x * short], axis=1)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.weights[:3] + self.weights[3], -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4) -> tuple:
    """Weights of the columns of x, then the constant, by Newton steps on standardised columns
    that are lightly held to zero."""
    if not len(x) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return (*[0.0] * x.shape[1], float(np.log(share / (1 - share))))
    mean, sd = x.mean(axis=0), x.std(axis=0)
    sd[sd == 0] = 1.0
    a = np.hstack([(x - mean) / sd, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    hold = np.diag([*[ridge] * x.shape[1], 1e-9])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) / len(y) + hold @ w
        hess = (a * (p * (1 - p))[:, None]).T @ a / len(y) + hold
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    slopes = w[:-1] / sd
    return (*slopes.tolist(), float(w[-1] - (slopes * mean).sum()))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> Model:
    """Fits on labelled documents that are not held out; ids with both labels are not used."""
    marked = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
              .groupBy(F.col(id_col).cast("long").alias("d"))
              .agg(F.min(label_col).alias("y"), F.max(label_col).alias("z")).where("y = z").select("d", "y"))
    count = {r.y: r.n for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}      # two rows

    def first(rows, n, of, seed):
        key = spread_key(F.col("d"), seed)
        return rows.where(key < spread_below(n, of)).orderBy(key, "d").limit(n)

    # of few labelled texts, half are left to calibrate on
    chosen = [first(marked.where(F.col("y") == y), min(DICTIONARY_DOCS, -(-count.get(y, 0) // 2)), count.get(y, 0), 0)
              .withColumn("use", F.lit("dictionary")) for y in (0, 1)]
    # spread over all labelled ids again, by another key
    chosen.append(first(marked, CALIBRATION_DOCS, sum(count.values()), 1).withColumn("use", F.lit("calibration")))
    ids = chosen[0].unionByName(chosen[1]).unionByName(chosen[2])
    ids = ids.groupBy("d", "y").agg(F.max("use").alias("use"))      # a dictionary text doesn't calibrate
    found = (docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).cast("binary").alias("text"))
             .join(F.broadcast(ids), "d").where("text is not null")     # at most 6,000 ids
             .select("d", "text", "y", "use").toArrow())
    rows = sorted(zip(found["d"].to_pylist(), found["text"].to_pylist(), found["y"].to_pylist(), found["use"].to_pylist()))
    model = Model(*(dictionary([t for _, t, y, use in rows if y == label and use == "dictionary"]) for label in (1, 0)))
    rest = [(t, y) for _, t, y, use in rows if use == "calibration"]
    if {y for _, y in rest} != {0, 1}:
        rest = [(t, y) for _, t, y, _ in rows]
    x = model.features([t for t, _ in rest]) if rest else np.empty((0, 3))
    model.weights = logistic(x, np.array([y for _, y in rest], dtype=float))
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.7, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """`id_col`, held_out, score (0 to 1), predicted (1 from `threshold` on) of every row.

    Null and empty texts have no difference: they get the curve's value for the shortest text. One row per input
    row; other columns are not read. A null id is not held out."""
    def run(batches):
        for batch in batches:
            s = model.scores(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                             names=[id_col, "score", "predicted"])
    src = docs.select(F.col(id_col).cast("long").alias(id_col),
                      F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    scored = src.mapInArrow(run, f"{id_col} long, score double, predicted int")
    return scored.select(id_col, F.coalesce(held_out(F.col(id_col)), F.lit(False)).alias("held_out"), "score", "predicted")
