import datetime as dt
import decimal
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tidewater.operators.summary import (budget_metrics, join_teams, monthly_team_cost,
                                         team_cost_summary, team_measures, top_spenders)
from tidewater.plans.catalog import q_team_cost_summary, q_team_cost_summary_all_teams

TEAMS = ("team_id string, team_name string, department string, plan_tier string, "
         "monthly_budget decimal(10,2), region string")
EVENTS = ("team_id string, team_name string, event_ts timestamp, is_ai_event boolean, "
          "cost_estimate_usd double, response_time_ms int")


def test_bands_and_guarded_ratio(spark):
    df = spark.createDataFrame([
        (0.5, 100.0), (1.0, 100.0), (1.0001, 100.0), (0.5001, 100.0), (5.0, 0.0), (5.0, None),
        (80.0, 100.0), (80.04, 100.0), (80.1, 100.0), (100.0, 100.0), (100.04, 100.0),
        (100.1, 100.0)], "total_cost_usd double, monthly_budget double")
    out = rows(budget_metrics(df, stamp_col=None))
    got = {(c, b): (p, t, s) for c, b, p, t, s in out}
    assert got[(0.5, 100.0)][1] == "LOW" and got[(1.0, 100.0)][1] == "MEDIUM"
    assert got[(1.0001, 100.0)][1] == "HIGH" and got[(0.5001, 100.0)][1] == "MEDIUM"
    assert got[(5.0, 0.0)] == (None, "HIGH", "ON_TRACK")
    assert got[(5.0, None)] == (None, "HIGH", "ON_TRACK")
    assert got[(80.0, 100.0)][2] == "ON_TRACK"
    assert got[(80.04, 100.0)][2] == "ON_TRACK"       # rounded to 80.0 before banding
    assert got[(80.1, 100.0)][2] == "WARNING"
    assert got[(100.04, 100.0)][2] == "WARNING"       # 100.0 is not over budget
    assert got[(100.1, 100.0)][2] == "OVER_BUDGET"


def _fixture(spark):
    t = dt.datetime(2024, 1, 1)
    events = spark.createDataFrame([
        ("t1", "One", t, True, 0.7, 100), ("t1", "One", t, False, 0.0, None),
        ("t9", "Ghost", t, True, 2.0, 300),                      # unknown team
    ], EVENTS)
    teams = spark.createDataFrame([
        ("t1", "One", "Eng", "Enterprise", D("1.00"), "EMEA"),
        ("t2", "Quiet", "Data", "Business", D("0.00"), "APAC"),        # no events, budget 0
    ], TEAMS)
    return events, teams


def test_keep_events_vs_teams(spark):
    events, teams = _fixture(spark)
    a = team_cost_summary(events, teams, stamp=False)
    got = {r["team_id"]: r.asDict() for r in a.collect()}
    assert set(got) == {"t1", "t9"}
    assert got["t1"]["total_events"] == 2 and got["t1"]["ai_api_calls"] == 1
    assert got["t1"]["avg_response_time_ms"] == 100.0          # NULL skipped
    assert got["t1"]["budget_used_pct"] == 70.0 and got["t1"]["cost_tier"] == "MEDIUM"
    assert got["t9"]["department"] is None and got["t9"]["cost_tier"] == "HIGH"
    b = team_cost_summary(events, teams, keep="teams", stamp=False)
    got = {r["team_id"]: r.asDict() for r in b.collect()}
    assert set(got) == {"t1", "t2"}
    assert got["t2"]["total_events"] == 0 and got["t2"]["team_name"] == "Quiet"
    assert got["t2"]["budget_used_pct"] is None and got["t2"]["budget_status"] == "ON_TRACK"


def test_contract_columns_and_stamp(spark):
    events, teams = _fixture(spark)
    g = team_cost_summary(events, teams)
    assert g.columns[-1] == "gold_created_at" and len(g.columns) == 16


def test_member_preaggregation_equals_direct(spark):
    direct = q_team_cost_summary(spark, SF_SMALL)
    assert direct.count() == 10                 # sf0.001: 10 of 25 nations have events
    assert q_team_cost_summary_all_teams(spark, SF_SMALL).count() == 25


def test_top_spenders_ties_by_team(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 0.5)], "team_id string, total_cost_usd double")
    out = top_spenders(df, 2, columns=("team_id",))
    assert [r[0] for r in out.collect()] == ["a", "b"]


def test_monthly_lag(spark):
    t = dt.datetime
    events = spark.createDataFrame([
        ("t1", "One", t(2024, 1, 5), True, 1.0, 1), ("t1", "One", t(2024, 2, 5), True, 3.0, 1),
        ("t1", "One", t(2024, 4, 5), True, 2.0, 1)], EVENTS)
    teams = spark.createDataFrame([("t1", "One", "Eng", "E", D("10.00"), "EMEA")], TEAMS)
    out = monthly_team_cost(events, teams, stamp=False).orderBy("month")
    assert [(r["prev_month_cost_usd"], r["cost_change_usd"]) for r in out.collect()] == [
        (None, None), (1.0, 2.0), (None, None)]


def test_join_teams_rejects_bad_keep(spark):
    events, teams = _fixture(spark)
    with pytest.raises(ValueError):
        join_teams(events.select("team_id"), teams, keep="all")
    assert F is not None


def test_unknown_members_stay_and_double_members_count_once(spark):
    ev = spark.createDataFrame([(1, True, 0.5), (2, True, 0.25), (3, False, 0.0)],
                               "user_id int, is_ai_event boolean, cost_estimate_usd double")
    ev = ev.selectExpr("*", "10 AS response_time_ms", "TIMESTAMP '2024-01-01' AS event_ts")
    mem = spark.createDataFrame([(1, "a", "A"), (1, "b", "B"), (2, "b", "B")], "user_id int, team_id string, team_name string")
    for per_member in (True, False):
        got = {r["team_id"]: (r["total_events"], r["total_cost_usd"])
               for r in team_measures(ev, members=mem, member_key="user_id", per_member=per_member).collect()}
        assert got == {"a": (1, 0.5), "b": (1, 0.25), None: (1, 0.0)}


@pytest.mark.parametrize("calls", [25, 75, 10_025])
def test_money_does_not_depend_on_partitions(spark, calls):
    ev = spark.range(calls).selectExpr("'t' AS team_id", "'T' AS team_name", "true AS is_ai_event",
                                       "0.000126D AS cost_estimate_usd", "1 AS response_time_ms",
                                       "TIMESTAMP '2024-01-01' AS event_ts")
    totals = {team_measures(ev.repartition(n)).first()["total_cost_usd"] for n in (1, 4, 16)}
    exact = (decimal.Decimal("0.000126") * calls).quantize(decimal.Decimal("0.0001"), decimal.ROUND_HALF_UP)
    assert totals == {float(exact)}


def test_change_is_against_the_calendar_month_before(spark):
    ev = spark.createDataFrame([("2024-02-03", 1.0), ("2024-04-01", 2.0), ("2024-05-01", 5.0)], "d string, cost_estimate_usd double")
    ev = ev.selectExpr("to_timestamp(d) AS event_ts", "cost_estimate_usd", "'t' AS team_id", "'T' AS team_name",
                       "true AS is_ai_event", "1 AS response_time_ms")
    teams = spark.createDataFrame([("t", "T", "d", "p", 10.0, "r")],
                                  "team_id string, team_name string, department string, plan_tier string, monthly_budget double, region string")
    got = {str(r["month"]): r["cost_change_usd"] for r in monthly_team_cost(ev, teams).collect()}
    assert got == {"2024-02-01": None, "2024-04-01": None, "2024-05-01": 3.0}


def test_no_job_runs_while_a_summary_is_built(spark):
    from conftest import SF_SMALL
    from tidewater.plans.catalog import q_decode_events, q_team_cost_summary
    sc = spark.sparkContext
    spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for q, name in ((q_team_cost_summary, "gold"), (q_decode_events, "decode")):
        sc.setJobGroup(f"build-{name}", "building")
        q(spark, SF_SMALL)
        jobs = sc.statusTracker().getJobIdsForGroup(f"build-{name}")
        # reading a Parquet footer for the schema may take a one-task job per table
        assert all(len(sc.statusTracker().getJobInfo(j).stageIds) == 1 for j in jobs)
    sc.setLocalProperty("spark.jobGroup.id", None)
