"""Silver as a stream: split, de-duplicate within the watermark, sessions.

Differences from the batch form, by construction of Structured Streaming:

* ``dropDuplicatesWithinWatermark`` keeps the *first* arrival of a key; the
  batch form keeps the latest by ``ingested_at``. Both agree whenever copies
  differ only in their ingest stamp (re-delivery).
* The duplicate state is bounded by *arrival* time: a re-delivery is known as
  such while its first copy arrived at most ``horizon`` before. Arrival stamps
  never run backwards from one micro-batch to the next, so no valid row is ever
  behind that watermark, however old its event time is.
* Sessions need a watermark on event time, which must be a TIMESTAMP (not
  TIMESTAMP_NTZ) column; the stream carries a TIMESTAMP copy of it.
* Append-mode sessions are emitted only once the watermark has passed the
  session's end plus the gap; sessions still open at the end of the input stay
  in state until later data advances the watermark.
* For sessions Spark guarantees only that rows within the watermark delay are
  kept. A row behind it may still join a session that is held in state
  (``tests/test_golden.py``), so streaming sessions can differ from the batch
  form for such late rows; Silver has them all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.columns import duration_minutes
from tidewater.functions.rules import RuleSet
from tidewater.operators.enrich import enrich_cost
from tidewater.operators.validate import split_valid
from tidewater.schemas import AI_COST_PER_CALL_USD, SESSION_GAP

WM_COL = "_event_time"


def silver_streams(typed: DataFrame, rules: RuleSet, key: str = "event_id",
                   arrival: str = "ingested_at", horizon: str = "10 minutes",
                   is_ai: Column | None = None, rate: float | Column = AI_COST_PER_CALL_USD
                   ) -> tuple[DataFrame, DataFrame]:
    """Return ``(silver, quarantine)`` streaming frames from a typed Bronze stream.

    Start each with :func:`tidewater.streaming.start_append` (two queries, two
    checkpoints). ``arrival`` is the Bronze stamp and ``horizon`` how long after
    its first copy a re-delivery is still recognised."""
    valid, bad = split_valid(typed, rules)
    deduped = valid.withWatermark(arrival, horizon).dropDuplicatesWithinWatermark([key])
    return enrich_cost(deduped, is_ai=is_ai, rate=rate), bad


def stream_sessions(events: DataFrame, keys: Sequence[str], ts: str = "event_ts",
                    gap: str = SESSION_GAP, watermark: str = "10 minutes") -> DataFrame:
    """Streaming sessions (append mode) with the batch form's output columns."""
    t = F.col(ts).cast("timestamp")
    out = (events.filter(F.col(ts).isNotNull())
           .withColumn(WM_COL, t).withWatermark(WM_COL, watermark)
           .groupBy(*keys, F.session_window(WM_COL, gap).alias("_sw"))
           .agg(F.min(ts).alias("session_start"), F.max(ts).alias("session_end"),
                F.count(F.lit(1)).alias("events_in_session"))
           .drop("_sw"))
    return out.withColumn("session_duration_minutes",
                          duration_minutes("session_start", "session_end"))
