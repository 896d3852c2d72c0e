"""Surrogate keys for appended facts: blocks of keys from a stored high-water table.

A fact needs unique keys, not dense or ordered ones. So nothing is sorted, counted beforehand or
checkpointed: a run claims the place above all keys given before, and inside the one write of the
run every task takes blocks of its own above that place: its n-th block lies at (n, task), and a
row's key is its place in the block. When the write is done, the largest key that it gave
(observed on the write itself) becomes the new high water.

The table is a folder with a small file for each claim, created only if absent, so two runs that
start together never share a place (drivers that start together need a file system whose
exclusive create is atomic, as HDFS; threads of one driver wait for each other). A claim not yet closed keeps a reserve that no task can
leave; a run that is tried again gets its claim back and replaces its own rows.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.writers import run_folder

BLOCK_BITS = 12                     # rows of a block
TASK_BITS = 22                      # tasks of a write
ROW_BITS = 33                       # rows of a task, as in monotonically_increasing_id
RESERVE = 1 << (ROW_BITS + TASK_BITS)       # no key of one write lies further above its place


_CLAIMING = threading.Lock()


@dataclass(frozen=True)
class Claim:
    number: int
    run_id: str
    first: int
    last: int | None                # None while the run has not finished

    @property
    def above(self) -> int:
        return self.first + RESERVE if self.last is None else self.last + 1


class KeyBlocks:
    """The high-water table of one surrogate key, in a folder that all runs share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _file(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _system(self):
        return self._file("_").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _put(self, name: str, content: dict, overwrite: bool = False) -> bool:
        """Write a small file; False if it is there already and must stay."""
        fs, path = self._system(), self._file(name)
        if not overwrite and fs.exists(path):
            return False
        try:
            out = fs.create(path, overwrite)
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        return True

    def claims(self) -> list[Claim]:
        """All claims by number (one small file per run, two once it is finished)."""
        fs, base = self._system(), self._file("")
        if not fs.exists(base):
            return []
        found: dict[int, dict] = {}
        for s in fs.listStatus(base):
            kind, _, number = s.getPath().getName().partition("=")
            if kind not in ("claim", "close"):
                continue
            stream = fs.open(s.getPath())
            try:
                text = bytes(stream.readAllBytes())
            finally:
                stream.close()
            if not text:
                raise RuntimeError(f"{s.getPath()} is just being written or broken; try again")
            found.setdefault(int(number), {}).update(json.loads(text))
        return [Claim(n, c["run_id"], c["first"], c.get("last")) for n, c in sorted(found.items())]

    def claim(self, run_id: str) -> Claim:
        """This run's place: a new one above all others, or the one it already has."""
        with _CLAIMING:
            while True:
                known = self.claims()
                for c in known:
                    if c.run_id == run_id:
                        return c
                number = known[-1].number + 1 if known else 0
                first = max((c.above for c in known), default=1)
                if self._put(f"claim={number:08d}", {"run_id": run_id, "first": first}):
                    return Claim(number, run_id, first, None)

    def close(self, claim: Claim, last: int) -> None:
        """The run is written; keys up to `last` are used. A run that is repeated never lowers it,
        as later claims may lie right above."""
        self._put(f"close={claim.number:08d}", {"last": max(last, claim.last or 0)}, overwrite=True)

    def high_water(self) -> int:
        return max((c.above for c in self.claims()), default=1) - 1


def block_key(first: int) -> Column:
    """A key for every row of the task it is evaluated in, different from all other tasks'."""
    task = F.spark_partition_id().cast("long")
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    block = F.shiftleft(F.shiftright(row, BLOCK_BITS), TASK_BITS) + task
    return F.lit(first) + F.shiftleft(block, BLOCK_BITS) + row.bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def append_with_keys(df: DataFrame, path: str, sk_col: str, blocks: KeyBlocks, run_id: str,
                     fmt: str = "parquet", partition_by: Sequence[str] = ()) -> dict:
    """Append `df` as the run's folder under `path`, with a new key in `sk_col` for every row.

    One job: keys are given in the tasks that write, after any exchange, so a recomputed exchange
    can't give one key twice. A repeated run replaces its rows and stays above its old place; if
    a later run has started meanwhile, it claims a new place instead. Returns the number
    of rows and the first and last key."""
    claim = blocks.claim(run_id)
    later = [c for c in blocks.claims() if c.number > claim.number]
    if claim.last is not None and later:
        # the closed range is taken on its upper side; a repeat may need more keys than it had
        claim = blocks.claim(f"{run_id}#{later[-1].number}")
    out = df.hint("rebalance", *partition_by) if partition_by else df
    keyed = out.withColumn(sk_col, block_key(claim.first))
    seen = Observation(f"keys-{claim.number}")
    keyed = keyed.observe(seen, F.count(F.lit(1)).alias("rows"), F.max(sk_col).alias("last"))
    keyed.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static") \
        .partitionBy(*partition_by).save(run_folder(path, run_id))
    got = seen.get
    last = got["last"] if got["last"] is not None else claim.first - 1
    blocks.close(claim, last)
    return {"rows": got["rows"], "first": claim.first, "last": last}
