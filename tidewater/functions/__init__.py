"""Column-level building blocks (all JVM-side expressions, no UDFs)."""

from tidewater.functions.columns import (band, duration_minutes, flag, guarded_pct,
                                         parse_time, unit_cost)
from tidewater.functions.rules import (CONFLUENCE_RULES, JIRA_RULES, Rule, RuleSet,
                                       min_length, not_null)

__all__ = ["band", "duration_minutes", "flag", "guarded_pct", "parse_time", "unit_cost",
           "Rule", "RuleSet", "JIRA_RULES", "CONFLUENCE_RULES", "not_null", "min_length"]
