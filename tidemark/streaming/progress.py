"""Live counts of a running sync (A7, A8): a listener that sums what each batch reports."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class Progress(StreamingQueryListener):
    """Rows and batches so far of each query; ``callback(query id, batch, rows so far)`` is called after every batch that read any.

    A batch that is replayed counts once, by its number.
    """

    def __init__(self, callback: Callable[[str, int, int], None] | None = None):
        self._callback, self._lock = callback, threading.Lock()
        self._rows: dict[str, dict[int, int]] = {}
        self.ended: dict[str, str | None] = {}

    def rows(self, query_id: str) -> int:
        with self._lock:
            return sum(self._rows.get(query_id, {}).values())

    def batches(self, query_id: str) -> int:
        with self._lock:
            return len(self._rows.get(query_id, {}))

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._rows.setdefault(str(event.id), {})

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if not progress.numInputRows:
            return
        with self._lock:
            seen = self._rows.setdefault(str(progress.id), {})
            seen[progress.batchId] = progress.numInputRows
            total = sum(seen.values())
        if self._callback is not None:
            self._callback(str(progress.id), progress.batchId, total)

    def onQueryIdle(self, event) -> None:
        """An idle query reads nothing."""

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self.ended[str(event.id)] = event.exception


def listen(spark: SparkSession, callback: Callable[[str, int, int], None] | None = None) -> Progress:
    """A listener on all queries of the session; ``spark.streams.removeListener`` ends it."""
    found = Progress(callback)
    spark.streams.addListener(found)
    return found
