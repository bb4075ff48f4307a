"""DataFrame -> DataFrame operators."""

from tidewater.operators.audit import audit_counts
from tidewater.operators.decode import decode_messages, parse_event_time, stamp, tag_source
from tidewater.operators.dedup import latest_per_key
from tidewater.operators.enrich import enrich_cost
from tidewater.operators.expectations import (Expectation, QualityGateError, enforce,
                                              quality_report, run_suite, silver_suite)
from tidewater.operators.sessions import average_session_by, sessionize
from tidewater.operators.summary import (budget_metrics, gold_contract, join_teams,
                                         monthly_team_cost, panel_spend_by_team,
                                         panel_totals, team_cost_summary,
                                         team_measures, top_spenders)
from tidewater.operators.validate import split_valid, with_reason

__all__ = [
    "audit_counts", "decode_messages", "parse_event_time", "stamp",
    "tag_source", "latest_per_key", "enrich_cost", "Expectation", "QualityGateError",
    "enforce", "quality_report", "run_suite", "silver_suite", "average_session_by",
    "sessionize", "budget_metrics", "gold_contract", "join_teams", "monthly_team_cost",
    "panel_spend_by_team", "panel_totals",  "team_cost_summary",
    "team_measures", "top_spenders", "split_valid", "with_reason",
]
