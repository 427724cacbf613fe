"""Run summaries of streams: named metrics, observed while rows are written and delivered by a query listener, with no second pass.

``write_stream(..., metrics=...)`` observes the metrics of each micro-batch under one name; :func:`run_summaries` listens while its
block runs and adds them up by query.  A micro-batch reports once when it is committed, so a retried batch counts once.  Sums cover what the runs inside the block
committed, not what earlier runs of the same checkpoint did.

Defined results: a run without new rows has no micro-batch and its summary is empty; a metric that is NULL in a batch adds nothing."""

from __future__ import annotations

import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from transcript_quality.sinks.writers import RUN_METRICS


class RunSummaries(StreamingQueryListener):
    def __init__(self):
        self._batches: dict[str, dict[int, dict]] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        metrics = progress.observedMetrics.get(RUN_METRICS)
        if metrics is not None:
            with self._lock:
                self._batches.setdefault(str(progress.runId), {})[progress.batchId] = metrics.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def of(self, query, wait: float = 60.0) -> dict[str, int]:
        """The sums of a query's run.  Events come by a thread of their own: for a query that has ended this waits until its end has been told."""
        run = str(query.runId)
        if not query.isActive and not self._end(run).wait(wait):
            raise TimeoutError(f"no end of run {run} within {wait} s")
        total: dict[str, int] = {}
        with self._lock:
            for metrics in self._batches.get(run, {}).values():
                for name, value in metrics.items():
                    total[name] = total.get(name, 0) + (value or 0)
        return total


@contextmanager
def run_summaries(spark: SparkSession):
    """A listener for the streams that run inside the block."""
    listener = RunSummaries()
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)
