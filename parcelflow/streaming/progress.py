"""Progress of running queries as rows."""

from __future__ import annotations

import math
import threading
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from parcelflow.model import INTAKE, PROGRESS


def finite(value) -> float:
    """The number, or 0 where a rate is missing, NaN or infinite."""
    number = float(value or 0)
    return number if math.isfinite(number) else 0.0


def progress_row(progress) -> tuple:
    """One row per micro-batch; state figures are summed over the operators."""
    took = progress.durationMs or {}
    states = progress.stateOperators or []
    return (
        datetime.now(timezone.utc).replace(microsecond=0),
        progress.name or "unnamed",
        int(progress.batchId or 0),
        int(progress.numInputRows or 0),
        finite(progress.inputRowsPerSecond),
        finite(progress.processedRowsPerSecond),
        int(took.get("triggerExecution", 0)),
        int(took.get("addBatch", 0)),
        sum(int(s.numRowsTotal or 0) for s in states),
        sum(int(s.memoryUsedBytes or 0) for s in states),
        sum(int(s.numRowsDroppedByWatermark or 0) for s in states),
    )


def intake_row(progress) -> tuple | None:
    """What ``plans.kpis.intake_stats`` counted in the batch; None for a query without it."""
    seen = (progress.observedMetrics or {}).get("intake")
    if seen is None:
        return None
    return (
        datetime.now(timezone.utc).replace(microsecond=0),
        str(progress.id),
        progress.name or "unnamed",
        int(progress.batchId or 0),
        int(progress.numInputRows or 0),
        int(seen["total"] or 0),
        int(seen["invalid"] or 0),
    )


class ProgressLog(StreamingQueryListener):
    """Collects progress and intake rows, one per micro-batch, until ``flush`` writes them.

    The listener's own thread runs no Spark job; the thread that waits for the queries
    flushes (see ``app.await_streams``).
    """

    def __init__(self, spark: SparkSession, write=None, write_intake=None):
        super().__init__()
        self.spark, self.write, self.write_intake = spark, write, write_intake
        self.rows: list[tuple] = []
        self.intake: list[tuple] = []
        self.ended: set[str] = set()
        self.lock = threading.Condition()

    def flush(self) -> int:
        """Write the rows collected so far; gives the number of progress rows."""
        with self.lock:
            rows, self.rows = self.rows, []
            intake, self.intake = self.intake, []
        if rows and self.write:
            self.write(self.spark.createDataFrame(rows, PROGRESS))
        if intake and self.write_intake:
            self.write_intake(self.spark.createDataFrame(intake, INTAKE))
        return len(rows)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        counted = intake_row(event.progress)
        with self.lock:
            self.rows.append(progress_row(event.progress))
            if counted is not None:
                self.intake.append(counted)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self.ended.add(str(event.runId))
            self.lock.notify_all()

    def settle(self, query) -> None:
        """Wait until all progress of a finished query has come in, and write it."""
        with self.lock:
            self.lock.wait_for(lambda: str(query.runId) in self.ended)
        self.flush()


@contextmanager
def logged(spark: SparkSession, write, write_intake=None) -> Iterator[ProgressLog]:
    """A log that listens while the block runs."""
    log = ProgressLog(spark, write, write_intake)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.streams.removeListener(log)
        log.flush()
