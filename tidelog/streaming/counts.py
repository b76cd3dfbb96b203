"""What the running jobs count: records, records that decode to nothing, and rows that came too late.

The jobs measure their records on the way (``changelog.counted``), in the pass that decodes them. A listener gathers the figures
of all queries of a session; :func:`batch_counts` reads those of one query from its progress.
"""

from __future__ import annotations

import threading

from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

#: Names of the metrics of the two logs.
DEVICE_COUNTS, READING_COUNTS = "decoded_devices", "decoded_readings"


def _counts(progress) -> list[dict]:
    """One row per log and batch; late rows are those of the whole query."""
    late = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
    return [
        {"query": progress.name, "batch_id": progress.batchId, "log": name, **row.asDict(), "late": late}
        for name, row in (progress.observedMetrics or {}).items() if name in (DEVICE_COUNTS, READING_COUNTS)]


def batch_counts(query: StreamingQuery) -> list[dict]:
    """The counts of a query's latest batches, as many as Spark keeps (``spark.sql.streaming.numRecentProgressUpdates``)."""
    return [row for progress in query.recentProgress for row in _counts(progress)]


class JobCounts(StreamingQueryListener):
    """Sums per query and log, and what the last batch had: ``spark.streams.addListener(JobCounts())``.

    ``alarm`` is called with a batch's counts when records decode to nothing or rows come too late in it.
    """

    def __init__(self, alarm=None) -> None:
        self._lock, self._sums, self._alarm = threading.Lock(), {}, alarm

    def totals(self) -> dict[tuple[str, str], dict[str, int]]:
        with self._lock:
            return {key: dict(row) for key, row in self._sums.items()}

    def onQueryProgress(self, event) -> None:
        for row in _counts(event.progress):
            figures = {k: v for k, v in row.items() if k not in ("query", "log", "batch_id")}
            with self._lock:
                sums = self._sums.setdefault((row["query"], row["log"]), dict.fromkeys(figures, 0))
                for k, v in figures.items():
                    sums[k] += v
            if self._alarm and any(v for k, v in figures.items() if k != "records"):
                self._alarm(row)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass
