"""Account of a tap stream's rows (W3): in, dead-lettered, late, duplicate, kept.

Spark drops late and repeated rows without a word.  A query listener reads the
counts that the running plan reports per micro-batch: observed counts before
validation and behind the de-duplication, and the drop counters of the stateful
operator.  ``rows_in = dead_lettered + late + duplicate + kept`` holds for every
batch.  A batch that is run again after a failure counts once.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tapflow.operators.dedup import dedup_taps_stream
from tapflow.operators.validate import GOOD, valid_taps

FIELDS = ("rows_in", "dead_lettered", "late", "duplicate", "kept")


def accounted_taps(rows: DataFrame) -> DataFrame:
    """Valid, de-duplicated taps of a stream, counted on the way."""
    good = F.coalesce(F.expr(GOOD), F.lit(False))
    seen = rows.observe("taps_in", F.count(F.lit(1)).alias("rows_in"), F.count_if(~good).alias("dead_lettered"))
    return dedup_taps_stream(valid_taps(seen)).observe("taps_kept", F.count(F.lit(1)).alias("kept"))


class RowAccount(StreamingQueryListener):
    """Counts of the query called ``name``; the query streams
    ``accounted_taps``.  Its events arrive behind the query: ``totals`` waits
    for its end."""

    def __init__(self, name: str):
        self.name = name
        self.batches: dict[int, dict[str, int]] = {}
        self._running: set[str] = set()
        self._ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self._running.add(str(event.runId))
            self._ended.clear()

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name != self.name:
            return
        observed = {k: v for row in progress.observedMetrics.values() for k, v in row.asDict().items()}
        counts = {k: observed.get(k) or 0 for k in ("rows_in", "dead_lettered", "kept")}
        for operator in progress.stateOperators:
            counts["late"] = counts.get("late", 0) + operator.numRowsDroppedByWatermark
            counts["duplicate"] = counts.get("duplicate", 0) + operator.customMetrics.get("numDroppedDuplicateRows", 0)
        # a batch may be reported again, by a retry or without rows
        before = self.batches.get(progress.batchId, {})
        self.batches[progress.batchId] = {k: max(before.get(k, 0), counts.get(k, 0)) for k in FIELDS}

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self._running:
            self._running.remove(str(event.runId))
            if not self._running:
                self._ended.set()

    def totals(self, timeout_s: float = 60.0) -> dict[str, int]:
        if not self._ended.wait(timeout_s):
            raise TimeoutError(f"query {self.name} has not ended")
        return {k: sum(b[k] for b in self.batches.values()) for k in FIELDS}
