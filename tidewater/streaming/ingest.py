"""Stateless stream ingest: source -> decode -> stamp -> checkpointed append.

Restart safety comes from the checkpoint plus the file sink's commit log: a
micro-batch that was running when an executor or the driver died is replayed
from the same offsets and its files are committed once.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidewater.operators.decode import decode_messages, stamp


def bronze_stream(messages: DataFrame, schema: StructType, value_col: str = "value",
                  keep: Sequence[str] = (), stamp_col: str = "ingested_at") -> DataFrame:
    """Decode each message with ``schema`` and stamp the ingest time (map-only)."""
    return stamp(decode_messages(messages, schema, value_col, keep), stamp_col)


def start_append(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                 trigger: dict | None = None, query_name: str | None = None,
                 partition_by: Sequence[str] = (), output_mode: str = "append") -> StreamingQuery:
    """Start a checkpointed append query into a table directory.

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (e.g.
    ``{"availableNow": True}`` or ``{"processingTime": "1 minute"}``); default is
    back-to-back micro-batches."""
    w = (stream.writeStream.format(fmt).outputMode(output_mode)
         .option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if trigger:
        w = w.trigger(**trigger)
    return w.start(path)


def await_all(queries: Sequence[StreamingQuery], timeout_s: float | None = None) -> None:
    """Wait until every query has ended.

    A failure of any of them is raised as soon as it is seen, and the others
    are stopped, so one feed cannot die unnoticed while another runs. Where the
    time runs out all are stopped and :class:`TimeoutError` is raised."""
    deadline = None if timeout_s is None else time.monotonic() + timeout_s
    pending = list(queries)
    while pending:
        for q in [q for q in pending if not q.isActive]:
            pending.remove(q)
            if (err := q.exception()) is not None:
                _stop(pending)
                raise RuntimeError(f"streaming query {q.name or q.id} failed") from err
        if not pending:
            return
        if deadline is not None and time.monotonic() > deadline:
            _stop(pending)
            raise TimeoutError(f"{len(pending)} streaming queries still ran after {timeout_s} s")
        try:
            pending[0].awaitTermination(1)
        except StreamingQueryException:
            continue   # the next round reports it


def _stop(queries: Sequence[StreamingQuery]) -> None:
    for q in queries:
        q.stop()
