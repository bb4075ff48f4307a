"""Scalar column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_time(c: ColumnOrName, fmt: str | None = None, ntz: bool = False) -> Column:
    """Text to timestamp; unparsable or missing text becomes NULL.

    ``try_to_timestamp`` instead of ``to_timestamp`` because ANSI mode makes the
    latter raise on bad input, which would abort the whole job instead of
    routing the row to quarantine. Accepts ISO text with or without fraction
    and with an offset such as ``+00:00``. ``ntz=True`` yields wall-clock UTC
    (with the session time zone pinned to UTC).
    """
    c = _col(c)
    if isinstance(c, Column):
        c = c.cast("string")
    ts = F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)
    return ts.cast("timestamp_ntz") if ntz else ts


def flag(predicate: Column) -> Column:
    """Boolean that is never NULL: a NULL predicate counts as false."""
    return F.when(predicate, F.lit(True)).otherwise(F.lit(False))


def unit_cost(predicate: Column, rate: float | Column) -> Column:
    """``rate`` for rows meeting ``predicate``, else 0.0 (never NULL for a literal rate)."""
    r = rate if isinstance(rate, Column) else F.lit(float(rate))
    return F.when(predicate, r.cast("double")).otherwise(F.lit(0.0))


def guarded_pct(numerator: ColumnOrName, denominator: ColumnOrName, scale: int = 1) -> Column:
    """``numerator / denominator * 100`` rounded; a zero or NULL denominator gives NULL."""
    d = _col(denominator)
    safe = F.when(d == 0, F.lit(None)).otherwise(d)
    return F.round(_col(numerator) / safe * 100, scale)


def band(value: ColumnOrName, thresholds: Sequence[float], labels: Sequence[str]) -> Column:
    """Ordered strict threshold banding.

    ``labels[i]`` when ``value > thresholds[i]`` for the first such ``i``;
    otherwise (including NULL) the last label. ``len(labels)`` must be
    ``len(thresholds) + 1``.
    """
    if len(labels) != len(thresholds) + 1:
        raise ValueError("need one more label than thresholds")
    v = _col(value)
    expr = None
    for t, lab in zip(thresholds, labels):
        expr = (F.when(v > t, lab) if expr is None else expr.when(v > t, lab))
    return expr.otherwise(labels[-1]) if expr is not None else F.lit(labels[-1])


def duration_minutes(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole-second difference in minutes, as double.

    ``unix_timestamp`` has second precision, so fractions are truncated
    before subtracting.
    """
    return ((F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))) / 60).cast("double")
