"""Derived Silver columns: AI flag and unit cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.columns import flag, unit_cost
from tidewater.schemas import AI_COST_PER_CALL_USD, AI_EVENT_TYPE


def enrich_cost(df: DataFrame, is_ai: Column | None = None,
                rate: float | Column = AI_COST_PER_CALL_USD,
                flag_col: str = "is_ai_event", cost_col: str = "cost_estimate_usd",
                stamp_col: str | None = "silver_processed_at") -> DataFrame:
    """Add ``is_ai_event`` (never NULL) and ``cost_estimate_usd`` (rate or 0.0)."""
    pred = is_ai if is_ai is not None else (F.col("event_type") == AI_EVENT_TYPE)
    out = df
    if stamp_col:
        out = out.withColumn(stamp_col, F.current_timestamp())
    return out.withColumn(flag_col, flag(pred)).withColumn(cost_col, unit_cost(pred, rate))
