"""Keep a streaming query going: progress is stored, a failed query starts again from its checkpoint."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidewater.sinks.lake import Lake

PROGRESS = ("query string, run string, batch_id long, at string, rows_in long, rows_dropped_by_watermark long, "
            "failure string")


class RowsDropped(RuntimeError):
    """The watermark dropped rows that should have been kept."""


class _Progress(StreamingQueryListener):
    """Progress rows of every query of the session since the last :meth:`take`."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        dropped = sum(o.get("numRowsDroppedByWatermark", 0) for o in p.get("stateOperators", []))
        self.rows.append((p["id"], p["runId"], p["batchId"], p["timestamp"], p["numInputRows"], dropped, None))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.rows.append((str(event.id), str(event.runId), None, None, None, None, event.exception[:2000]))

    def take(self) -> list[tuple]:
        out, self.rows = self.rows, []
        return out


def run_supervised(spark: SparkSession, start: Callable[[], StreamingQuery], progress: Lake,
                   max_restarts: int = 3, back_off_s: float = 1.0, allow_drops: bool = False) -> int:
    """Run the query that ``start`` starts until it ends by itself; returns how often it was started again.

    ``start`` must use one checkpoint, so that a restart goes on where the last
    run failed. The wait doubles with every restart; after ``max_restarts`` the
    failure is raised. Progress (batches, rows in, rows dropped by a watermark,
    failures) goes to the table ``progress`` of the given lake after every run,
    and a run that dropped rows raises :class:`RowsDropped`.
    """
    listener, failure = _Progress(), None
    spark.streams.addListener(listener)
    try:
        for attempt in range(max_restarts + 1):
            if attempt:
                time.sleep(back_off_s * 2 ** (attempt - 1))
            query = start()
            try:
                query.awaitTermination()
                failure = None
            except Exception as e:  # the query's own error, whatever it is
                failure = e
            spark._jsc.sc().listenerBus().waitUntilEmpty(10_000)
            rows = listener.take()
            if rows:
                progress.append("progress", spark.createDataFrame(rows, PROGRESS))
            dropped = sum(r[5] or 0 for r in rows)
            if dropped and not allow_drops:
                raise RowsDropped(f"{dropped} rows came behind the watermark")
            if failure is None:
                return attempt
        raise failure
    finally:
        spark.streams.removeListener(listener)


__all__ = ["RowsDropped", "run_supervised"]
