"""Feed, dimension and output schemas, plus the fixed values of the domain."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DateType, DecimalType, DoubleType,
                               IntegerType, LongType, StringType, StructField, StructType,
                               TimestampType)


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType(), True) for n in names]


# ---------------------------------------------------------------------------
# These must equal the original pipeline's for equal results.
# ---------------------------------------------------------------------------
# Ingest schemas: explicit, every field nullable, times still text.
JIRA_EVENT = StructType(
    _strings("event_id", "event_type", "event_ts", "team_id", "team_name", "user_id",
             "user_email", "project_key", "issue_id", "priority")
    + [StructField("response_time_ms", IntegerType(), True),
       StructField("ai_assist_used", BooleanType(), True),
       StructField("source_app", StringType(), True)])

CONFLUENCE_EVENT = StructType(
    _strings("event_id", "event_type", "event_ts", "team_id", "team_name", "user_id",
             "user_email", "space_key", "page_id", "page_title")
    + [StructField("response_time_ms", IntegerType(), True),
       StructField("ai_assist_used", BooleanType(), True),
       StructField("source_app", StringType(), True)])

# Relational dimensions as they arrive over JDBC.
TEAMS = StructType([
    StructField("team_id", StringType(), False),
    StructField("team_name", StringType(), False),
    StructField("department", StringType(), True),
    StructField("plan_tier", StringType(), True),
    StructField("monthly_budget", DecimalType(10, 2), True),
    StructField("region", StringType(), True),
    StructField("created_at", TimestampType(), True),
    StructField("is_active", BooleanType(), True),
])

USERS = StructType(
    _strings("user_id", "team_id", "full_name", "role", "seniority")
    + [StructField("is_active", BooleanType(), True), StructField("joined_at", TimestampType(), True)])

PROJECTS = StructType(
    _strings("project_key", "team_id", "project_name", "status")
    + [StructField("created_at", TimestampType(), True)])

JIRA_EVENT_TYPES = ("issue_created", "issue_updated", "issue_closed",
                    "comment_added", "ai_assist", "sprint_started")
AI_EVENT_TYPE = "ai_assist"
AI_COST_PER_CALL_USD = 0.000126
SESSION_GAP = "30 minutes"
MIN_SILVER_ROWS = 100
RESPONSE_TIME_BOUNDS_MS = (0, 5000)
COST_TIER_THRESHOLDS = (1.0, 0.5)          # HIGH above the first, MEDIUM above the second
BUDGET_STATUS_THRESHOLDS = (100.0, 80.0)   # OVER_BUDGET above the first, WARNING above the second
QUALITY_PIPELINE_NAME = "medallion"
QUALITY_TABLE_NAME = "silver_jira_events_clean"

# Gold contract: 16 columns in this order.
GOLD_COLUMNS = (
    "team_id", "team_name", "department", "plan_tier", "region",
    "total_events", "ai_api_calls",
    "total_cost_usd", "monthly_budget", "budget_used_pct",
    "avg_response_time_ms",
    "cost_tier", "budget_status",
    "period_start", "period_end",
    "gold_created_at",
)

# Columns shown by the ordered preview of the Gold table.
GOLD_PREVIEW_COLUMNS = ("team_name", "plan_tier", "total_events", "ai_api_calls",
                        "total_cost_usd", "monthly_budget", "budget_used_pct",
                        "cost_tier", "budget_status")

# An appended quality report, as the gate and the history read it back.
REPORT = StructType(
    _strings("pipeline", "table")
    + [StructField("total_rows_checked", LongType(), True), StructField("checks_passed", LongType(), True),
       StructField("checks_failed", LongType(), True), StructField("quality_score_pct", DoubleType(), True),
       StructField("results", ArrayType(StructType(
           _strings("check", "description", "status", "details")
           + [StructField("timestamp", TimestampType(), True)])), True),
       StructField("run_timestamp", TimestampType(), True), StructField("run_id", StringType(), True),
       StructField("run_date", DateType(), True)])
