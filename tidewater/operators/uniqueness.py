"""Uniqueness of an id kept up to date day by day, without reading older days' rows again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.sinks.lake import Change
from tidewater.sinks.upsert import replace_touched


def index_ids(change: Change, table: str, rows: DataFrame, key: str, day: str) -> None:
    """Put the ids of the days in ``rows`` into the index ``table``: (id, its rows that day) per day.

    A day that comes again replaces what the index had of it. Copies of an id
    collapse map-side."""
    counted = rows.groupBy(F.col(key).cast("string").alias("id"), F.col(day)).agg(F.count(F.lit(1)).alias("n"))
    replace_touched(change, table, counted, [day])


def index_counts(index: DataFrame, day: str) -> DataFrame:
    """One row: rows, distinct ids (NULL is one), rows beyond the first of their id, and ids of several days."""
    per_id = index.groupBy("id").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("days"))
    return per_id.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_ids"),
                      F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
                      F.count_if(F.col("days") > 1).alias("ids_on_several_days"))


__all__ = ["index_counts", "index_ids"]
