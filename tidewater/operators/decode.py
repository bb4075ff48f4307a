"""Payload decoding, time parsing and audit stamps (map-only, no shuffle)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.functions.columns import parse_time


def decode_messages(messages: DataFrame, schema: StructType, value_col: str = "value",
                    keep: Sequence[str] = (), options: dict[str, str] | None = None) -> DataFrame:
    """Bytes or text holding one JSON object -> one typed column per schema field.

    Works on a Kafka-shaped frame or on any frame with a ``value`` column.
    Malformed or NULL payloads give an all-NULL row (they are quarantined
    later as "missing event_id"); a single field of the wrong type becomes
    NULL while the other fields survive.

    The struct is expanded through ``inline(array(...))``: the generator
    evaluates the parse exactly once per row. Expanding with ``data.*``
    instead lets the optimizer give every referenced field its own pruned
    ``from_json`` and lets downstream filters inline the payload expression
    again, i.e. one JSON parse per field reference.
    """
    payload = F.from_json(F.col(value_col).cast("string"), schema, options or {})
    return messages.select(*keep, F.inline(F.array(payload)))


def stamp(df: DataFrame, name: str) -> DataFrame:
    """Processing-time audit column; one constant value per query / micro-batch."""
    return df.withColumn(name, F.current_timestamp())


def tag_source(df: DataFrame, source: str, name: str = "source") -> DataFrame:
    """Provenance literal."""
    return df.withColumn(name, F.lit(source))


def parse_event_time(df: DataFrame, column: str = "event_ts", fmt: str | None = None,
                     ntz: bool = False) -> DataFrame:
    """Replace a text time column by its parsed timestamp; bad text becomes NULL."""
    return df.withColumn(column, parse_time(column, fmt, ntz))
