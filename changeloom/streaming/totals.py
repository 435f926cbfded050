"""Sums over everything that running streams report, however many reports Spark retains."""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class StreamTotals(StreamingQueryListener):
    """Adds up input rows, late rows and batches per run while it is registered.

    ``with StreamTotals.of(spark) as totals`` registers and removes it.  Reports arrive after the batch they are about, so the
    sums of a run are whole once :meth:`wait` has seen its end.  One small entry per run is held.
    """

    def __init__(self) -> None:
        self._changed = threading.Condition()
        self._sums: dict[str, dict[str, int]] = {}
        self._ended: set[str] = set()
        self._spark: SparkSession | None = None

    @classmethod
    def of(cls, spark: SparkSession) -> StreamTotals:
        made = cls()
        made._spark = spark
        return made

    def __enter__(self) -> StreamTotals:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self._spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._sums.setdefault(str(event.runId), {"batches": 0, "input_rows": 0, "late_rows": 0})

    def onQueryProgress(self, event) -> None:
        report = event.progress
        with self._changed:
            sums = self._sums.setdefault(str(report.runId), {"batches": 0, "input_rows": 0, "late_rows": 0})
            sums["batches"] += 1
            sums["input_rows"] += int(report.numInputRows)
            sums["late_rows"] += sum(int(s.numRowsDroppedByWatermark) for s in report.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def wait(self, query, seconds: float = 60.0) -> dict[str, int]:
        """Sums of a run that has ended, once all its reports are here; raises ``TimeoutError`` if they do not come."""
        run = str(query.runId)
        with self._changed:
            if not self._changed.wait_for(lambda: run in self._ended, seconds):
                raise TimeoutError(f"the end of run {run} was not reported")
            return dict(self._sums.get(run, {"batches": 0, "input_rows": 0, "late_rows": 0}))

    def now(self, query) -> dict[str, int]:
        """Sums of a run as far as they are reported."""
        with self._changed:
            return dict(self._sums.get(str(query.runId), {"batches": 0, "input_rows": 0, "late_rows": 0}))
