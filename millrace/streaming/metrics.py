"""What every micro-batch of a stream read, kept and left out, as a table."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

BATCHES = ("query string, run string, batch_id bigint, rows_read bigint, late_rows bigint, state_rows bigint, "
           "watermark string, milliseconds bigint")


class BatchMetrics(StreamingQueryListener):
    """Keeps one row per micro-batch of every stream of the session while it is attached.

    ``late_rows`` counts the rows that reached a stateful operator behind the
    watermark and were dropped there.  Before an aggregation they have been
    combined already, so late *events* are counted in front of it, by a
    deduplication.  Replayed batches are reported again; the last report of a
    (query, batch) counts.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._rows: dict[tuple[str, int], tuple] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def __enter__(self) -> BatchMetrics:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        self.spark.streams.removeListener(self)

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:  # noqa: N802  the names are Spark's
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        states = p.stateOperators
        row = (str(p.id), str(p.runId), p.batchId, p.numInputRows, sum(s.numRowsDroppedByWatermark for s in states),
               sum(s.numRowsTotal for s in states), (p.eventTime or {}).get("watermark"), p.batchDuration)
        with self._lock:
            kept = self._rows.get(row[:1] + row[2:3])
            # A batch without data reports again under the next id only once it runs; an idle trigger repeats the last id.
            if kept is None or p.numInputRows or row[1] != kept[1]:
                self._rows[row[:1] + row[2:3]] = row

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._end(str(event.runId)).set()

    def finished(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until ``query`` has ended and all its batches are reported."""
        query.awaitTermination()
        if not self._end(str(query.runId)).wait(seconds):
            raise TimeoutError("the end of the stream was not reported")

    def table(self) -> DataFrame:
        """One row per micro-batch: what it read, what came too late, the state it left, its watermark and duration."""
        with self._lock:
            rows = sorted(self._rows.values(), key=lambda r: (r[0], r[2]))
        return self.spark.createDataFrame(rows, BATCHES)
