"""Physical-plan properties the operators are designed for (checked after
execution, on the final adaptive plan)."""

import re

from conftest import SF_SMALL
from tidewater.operators.decode import decode_messages
from tidewater.plans.catalog import (event_messages, q_latest_per_key, q_team_cost_summary,
                                     q_user_sessions)
from tidewater.schemas import JIRA_EVENT


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _formatted(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_flagship_prunes_and_aggregates_before_shuffle(spark):
    df = q_team_cost_summary(spark, SF_SMALL)
    text = _formatted(df)
    events_scan = [ln for ln in text.splitlines()
                   if ln.startswith("ReadSchema") and "event_type" in ln][0]
    assert "props" not in events_scan and "event_id" not in events_scan
    plan = _final_plan(df)
    assert "partial_count" in plan and "SortMergeJoin" not in plan
    # the dimension is joined to the few per-team rows, by broadcast
    assert re.search(r"BroadcastHashJoin \[[^\]]*\], \[[^\]]*\], LeftOuter", plan)


def test_decode_parses_once_per_row(spark):
    df = decode_messages(event_messages(spark, SF_SMALL), JIRA_EVENT).filter("event_id IS NOT NULL")
    plan = _final_plan(df)
    assert plan.count("from_json") == 1


def test_sessions_exchange_candidates_only(spark):
    """Both levels read one scan and one first exchange; only sessions near a
    bucket's edge are exchanged again, and at the defaults they are few."""
    plan = _final_plan(q_user_sessions(spark, SF_SMALL))
    assert plan.count("ReusedExchange") == 1
    assert "MergingSessions" in plan
    candidates = plan.split("Window [lag")[1].split("Exchange hashpartitioning")[1]
    assert " OR " in candidates.split("MergingSessions")[0]     # the edge filter stands below the second exchange


def test_few_sessions_are_candidates(spark):
    from pyspark.sql import functions as F
    from tidewater.operators.sessions import interval_micros
    s = q_user_sessions(spark, SF_SMALL)
    day, gap = interval_micros("1 day"), interval_micros("30 minutes")
    at = lambda c: F.pmod(F.unix_micros(F.col(c).cast("timestamp")), F.lit(day))
    inner = s.filter((at("session_start") >= gap) & (at("session_end") < day - gap)).count()
    assert inner > 0.9 * s.count()


def test_dedup_limits_before_exchange(spark):
    plan = _final_plan(q_latest_per_key(spark, SF_SMALL))
    assert plan.count("WindowGroupLimit") == 2               # partial (map side) + final


def test_stream_sessions_merge_before_shuffle(spark):
    from tidewater.plans.catalog import events_stream
    from tidewater.session import scratch_path
    from tidewater.streaming.ingest import await_all, start_append
    from tidewater.streaming.silver import stream_sessions
    base = scratch_path(spark, "test_stream_plan")
    s = stream_sessions(events_stream(spark, SF_SMALL), ["user_id"], ts="ts")
    q = start_append(s, f"{base}/out", f"{base}/ck", trigger={"availableNow": True})
    await_all([q])
    plan = q._jsq.streamingQuery().lastExecution().executedPlan().toString()
    below_exchange = plan.split("Exchange hashpartitioning", 1)[1]
    assert "MergingSessions" in below_exchange      # map-side merge of a key's events
