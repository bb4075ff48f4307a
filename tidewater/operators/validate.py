"""Valid / quarantine split with the first failing rule as reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.rules import RuleSet

REASON = "quarantine_reason"


def with_reason(df: DataFrame, rules: RuleSet, reason_col: str = REASON) -> DataFrame:
    """Add the reason of the first failing rule (NULL for a valid row)."""
    return df.withColumn(reason_col, rules.reason())


def split_valid(df: DataFrame, rules: RuleSet, reason_col: str = REASON,
                stamp_col: str | None = "quarantined_at") -> tuple[DataFrame, DataFrame]:
    """Return ``(valid, quarantined)``; together they hold every input row once.

    The valid side filters on the plain conjunction (so not-null parts reach
    the scan as pushed filters); the quarantined side on "reason is not NULL".
    Both are map-only.
    """
    valid = df.filter(rules.valid())
    bad = with_reason(df, rules, reason_col).filter(F.col(reason_col).isNotNull())
    if stamp_col:
        bad = bad.withColumn(stamp_col, F.current_timestamp())
    return valid, bad
