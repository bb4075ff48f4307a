"""Keep the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column],
                   tie_breakers: Sequence[Column] = ()) -> DataFrame:
    """One row per ``keys``: the first row under ``order_by`` then ``tie_breakers``.

    ``order_by`` carries its direction, e.g. ``[F.col("ingested_at").desc()]``.
    Rows tied on every ordering column are resolved arbitrarily, so pass a
    tie-breaker list whenever ties can differ in other columns.

    Planned as ``row_number() = 1``: Catalyst turns that into a partial
    ``WindowGroupLimit`` before the exchange, so a key with millions of copies
    ships at most one row per map partition — the hot key cannot swamp one task.
    """
    rn = "_tw_rn"
    w = Window.partitionBy(*keys).orderBy(*order_by, *tie_breakers)
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)
