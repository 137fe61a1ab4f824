"""Counters of running queries, written micro-batch by micro-batch.

A listener takes each progress report as it is posted, so nothing polls and no
report is missed between two looks.  It appends one row per micro-batch and
counter to a Parquet table, and wakes whoever waits for a number of
micro-batches.
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SCHEMA = "query_id string, batch_id long, source string, counter string, key string, value long"
#: Days of one micro-batch that are counted one by one.
DAYS = 1000
#: How long the report of an ended run may take.
REPORT_SECONDS = 120.0


def day_counts(day: str = "day") -> Column:
    """Rows by day as one observable aggregate: exact up to ``DAYS`` days a micro-batch.

    The sketch tracks ten times as many days; with fewer distinct ones than it
    tracks, its counts are no estimates.
    """
    return F.expr(f"approx_top_k(`{day}`, {DAYS}, {10 * DAYS})")


def counter_rows(query_id: str, batch_id: int, metrics: dict[str, Row]) -> list[tuple]:
    """One row per counter of the observations of a progress report."""
    rows = []
    for source, values in metrics.items():
        for counter, value in values.asDict().items():
            if isinstance(value, (list, tuple)):
                rows += [(query_id, batch_id, source, counter, str(e["item"]), int(e["count"])) for e in value]
            elif isinstance(value, int):
                rows.append((query_id, batch_id, source, counter, None, value))
    return rows


class CounterListener(StreamingQueryListener):
    """Writes the observed counters of all queries of the session to a table.

    A micro-batch that runs again after a failure writes its rows again;
    :func:`read_counters` returns each counter once.  Reports of a run come
    before its end, so what has been waited for has been written.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._change = threading.Condition()
        self._batches: dict[str, set[int]] = {}
        self._ended: set[str] = set()
        self.failure: Exception | None = None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        query_id = str(progress.id)
        rows = counter_rows(query_id, progress.batchId, dict(progress.observedMetrics or {}))
        try:
            if rows and progress.numInputRows:
                self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        except Exception as error:  # told to whoever waits: a listener's errors are only logged
            self.failure = error
        with self._change:
            if progress.numInputRows:
                self._batches.setdefault(str(progress.runId), set()).add(progress.batchId)
            self._change.notify_all()

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def batches(self, query: StreamingQuery) -> int:
        """Micro-batches with data that this run of the query has reported."""
        return len(self._batches.get(str(query.runId), ()))

    def run_batches(self, query: StreamingQuery, batches: int, timeout: float | None = None) -> int:
        """Wait for so many micro-batches with data of this run, then stop it.

        Returns the number completed, which may be more.  Ends early with the
        query; a missed ``timeout`` (seconds) stops it and raises.
        """

        def done() -> bool:
            return self.batches(query) >= batches or str(query.runId) in self._ended

        end = None if timeout is None else time.monotonic() + timeout
        unreported = None  # since when the query has ended without a report of it
        in_time = True
        with self._change:
            while not done() and in_time:
                self._change.wait(1.0)
                now = time.monotonic()
                in_time = end is None or now < end
                if not query.isActive:
                    unreported = unreported or now
                    if now - unreported > REPORT_SECONDS:
                        raise RuntimeError(f"the end of run {query.runId} was not reported; was the listener added before it?")
            reached = done()
        query.stop()
        if query.exception() is not None:
            raise query.exception()
        if not reached:
            raise TimeoutError(f"{self.batches(query)} of {batches} micro-batches in {timeout} s")
        if self.failure is not None:
            raise self.failure
        return self.batches(query)


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """The table of counters, each micro-batch once."""
    keys = ["query_id", "batch_id", "source", "counter", "key"]
    return spark.read.schema(SCHEMA).parquet(path).groupBy(*keys).agg(F.max("value").alias("value"))
