"""Row-validity rules: a validity predicate plus the first failing rule's reason.

A rule's predicate may be NULL (for example ``length(NULL) > 3``); a NULL
predicate counts as failing, so the valid and the quarantined side always
partition the input.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named predicate; ``reason`` is recorded when it is the first to fail.

    ``predicate`` is a Column or a zero-argument function building one (so rule
    sets can be module constants, defined before any session exists)."""

    reason: str
    predicate: Column | Callable[[], Column]

    def expr(self) -> Column:
        return self.predicate() if callable(self.predicate) else self.predicate

    def holds(self) -> Column:
        return F.coalesce(self.expr(), F.lit(False))


def not_null(column: str, reason: str | None = None) -> Rule:
    return Rule(reason or f"missing {column}", lambda: F.col(column).isNotNull())


def min_length(column: str, exclusive_min: int, reason: str) -> Rule:
    """``length(column) > exclusive_min``."""
    return Rule(reason, lambda: F.length(F.col(column)) > exclusive_min)


@dataclass(frozen=True)
class RuleSet:
    rules: Sequence[Rule]

    def valid(self) -> Column:
        """Conjunction of all rules; may be NULL. As a filter it keeps exactly
        the rows where every rule is TRUE (NULL counts as failing); it is left
        free of ``coalesce`` so the not-null parts can be pushed down to the
        scan. Wrap in ``coalesce(.., false)`` before using it as a value."""
        expr = None
        for r in self.rules:
            expr = r.expr() if expr is None else expr & r.expr()
        return expr if expr is not None else F.lit(True)

    def reason(self) -> Column:
        """Reason of the first failing rule in list order; NULL when all hold."""
        expr = None
        for r in self.rules:
            cond = ~r.holds()
            expr = F.when(cond, F.lit(r.reason)) if expr is None else expr.when(cond, F.lit(r.reason))
        return expr if expr is not None else F.lit(None).cast("string")


# ---------------------------------------------------------------------------
# Rule order and reason texts of the two event feeds.
# ---------------------------------------------------------------------------
JIRA_RULES = RuleSet([
    not_null("event_id", "missing event_id"),
    not_null("event_ts", "invalid timestamp"),
    not_null("team_id", "missing team_id"),
    not_null("user_id", "missing user_id"),
    not_null("user_email", "missing email"),
    min_length("user_email", 3, "email too short"),
])

CONFLUENCE_RULES = RuleSet([
    not_null("event_id", "missing event_id"),
    not_null("event_ts", "invalid timestamp"),
    not_null("team_id", "missing team_id"),
    not_null("user_id", "missing user_id"),
    not_null("space_key", "missing space_key"),
    not_null("page_id", "missing page_id"),
])
