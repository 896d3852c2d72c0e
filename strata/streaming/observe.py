"""Counts of every micro-batch in the run ledger, observed by the write itself (no extra job)."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.report import Ledger
from . import ingest


class BatchListener(StreamingQueryListener):
    """Records each progress that holds the metrics `name`. Spark keeps only the newest hundred
    progresses of a query; a listener gets all of them. A batch reported twice counts once."""

    def __init__(self, name: str):
        self.name, self.batches, self.error, self.done = name, {}, None, threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics.get(self.name)
        if found is not None and found["rows"]:
            self.batches[event.progress.batchId] = (found["rows"], found["passed"], event.progress.batchDuration / 1000)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.error = event.exception
        self.done.set()


def drain_observed(stream: DataFrame, passed: Column, sink_path: str, checkpoint: str, ledger: Ledger,
                   step: str, wait_s: float = 60) -> dict:
    """`ingest.drain` with one ledger row per micro-batch: rows that came, rows that `passed` (a NULL
    has not), seconds. A failed drain adds a FAILED row after those of its finished batches, and
    raises. Other queries of the session must not end while this one runs."""
    spark, listener = stream.sparkSession, BatchListener(step)
    counted = stream.observe(step, F.count(F.lit(1)).alias("rows"), F.count_if(passed).alias("passed"))
    spark.streams.addListener(listener)
    failed = None
    try:
        return ingest.drain(counted, sink_path, checkpoint)
    except Exception as e:
        failed = e
        raise
    finally:
        listener.done.wait(wait_s)
        spark.streams.removeListener(listener)
        for batch, (rows, ok, seconds) in sorted(listener.batches.items()):
            ledger.rows.append((f"{step}/{batch}", "OK", rows, ok, seconds, ledger.ctx.run_id))
        if failed is not None or listener.error:
            ledger.rows.append((step, "FAILED", None, None, None, ledger.ctx.run_id))
