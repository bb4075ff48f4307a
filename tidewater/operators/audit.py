"""Audit counters of a Silver run, computed in one aggregate pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def audit_counts(df: DataFrame, keys: Sequence[str], valid: Column | None = None) -> DataFrame:
    """One row: input, quarantined, valid, output (distinct keys among valid rows),
    duplicates_removed.

    ``valid`` is the validity predicate (default: every row valid). One scan
    replaces the separate count jobs of a naive implementation; the distinct
    count runs as a two-phase aggregate whose map side already collapses copies.
    """
    ok = F.coalesce(valid, F.lit(False)) if valid is not None else F.lit(True)
    key = F.struct(*[F.col(k) for k in keys])
    counted = df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(~ok).alias("rows_quarantined"),
        F.count_if(ok).alias("rows_valid"),
        F.count_distinct(F.when(ok, key)).alias("rows_out"),
    )
    return counted.withColumn("duplicates_removed", F.col("rows_valid") - F.col("rows_out"))

