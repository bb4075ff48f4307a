import pytest

from conftest import SF_SMALL, rows
from tidewater.operators.expectations import (QualityGateError, enforce, quality_report,
                                              run_suite, score_history, silver_suite)
from tidewater.schemas import JIRA_EVENT_TYPES

COLS = "event_id string, event_type string, response_time_ms int, cost_estimate_usd double, is_ai_event boolean"


def _clean(n=100):
    return [(f"id{i}", "ai_assist" if i % 2 else "issue_created", 100,
             0.000126 if i % 2 else 0.0, bool(i % 2)) for i in range(n)]


def _status(spark, data, **kw):
    df = spark.createDataFrame(data, COLS)
    res = run_suite(df, silver_suite(JIRA_EVENT_TYPES, **kw))
    return {r["check"]: (r["status"], r["details"]) for r in res.collect()}


def test_all_pass_and_nulls_pass(spark):
    data = _clean(99) + [("idx", None, None, None, False)]   # NULL type / time / cost pass
    got = _status(spark, data)
    assert all(s == "PASSED" for s, _ in got.values()), got


@pytest.mark.parametrize("row,check", [
    ((None, "ai_assist", 1, 0.000126, True), "event_id_not_null"),
    (("x", "bogus", 1, 0.0, False), "event_type_valid_values"),
    (("x", "ai_assist", 5001, 0.000126, True), "response_time_in_range"),
    (("x", "ai_assist", -1, 0.000126, True), "response_time_in_range"),
    (("x", "issue_created", 1, -0.5, False), "cost_not_negative"),
    (("x", "issue_created", 1, 0.0, None), "is_ai_event_not_null"),
    (("id1", "ai_assist", 1, 0.000126, True), "no_duplicate_event_ids"),
    (("x", "ai_assist", 1, 0.0, True), "ai_cost_consistency"),
    (("x", "issue_created", 1, 0.5, False), "ai_cost_consistency"),
])
def test_each_check_fails_alone(spark, row, check):
    got = _status(spark, _clean() + [row])
    failed = {k for k, (s, _) in got.items() if s == "FAILED"}
    expected = {check}
    if check == "cost_not_negative":
        pass
    assert failed == expected, got


def test_boundaries_inclusive(spark):
    data = _clean(98) + [("lo", "issue_created", 0, 0.0, False), ("hi", "issue_created", 5000, 0.0, False)]
    assert _status(spark, data)["response_time_in_range"][0] == "PASSED"


def test_minimum_rows_99_vs_100(spark):
    assert _status(spark, _clean(99))["minimum_row_count"] == (
        "FAILED", "99 rows; the minimum is 100")
    assert _status(spark, _clean(100))["minimum_row_count"][0] == "PASSED"


def test_null_id_counts_once_as_value(spark):
    data = _clean() + [(None, "issue_created", 1, 0.0, False)]
    got = _status(spark, data)
    assert got["no_duplicate_event_ids"][0] == "PASSED"
    data += [(None, "issue_created", 1, 0.0, False)]
    assert _status(spark, data)["no_duplicate_event_ids"] == ("FAILED", "1 repeated values of event_id")


def test_gate_and_report(spark):
    df = spark.createDataFrame(_clean() + [("id1", "bogus", 1, 0.0, False)], COLS)
    res = run_suite(df, silver_suite(JIRA_EVENT_TYPES), stamp=True)
    with pytest.raises(QualityGateError):
        enforce(res)
    rep = quality_report(res).collect()[0]
    assert (rep["checks_passed"], rep["checks_failed"], rep["quality_score_pct"]) == (6, 2, 75.0)
    assert rep["total_rows_checked"] == 101 and len(rep["results"]) == 8
    enforce(run_suite(spark.createDataFrame(_clean(), COLS), silver_suite(JIRA_EVENT_TYPES)))


def test_suite_is_one_scan(spark):
    df = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    from tidewater.plans.catalog import clean_suite, priced_events
    res = run_suite(priced_events(spark, SF_SMALL), clean_suite())
    res.collect()
    plan = res._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Scan parquet") == 1
    assert rows(res.select("status")).count(("PASSED",)) == 8
    assert df is not None


def test_score_history(spark):
    good = quality_report(run_suite(spark.createDataFrame(_clean(), COLS),
                                    silver_suite(JIRA_EVENT_TYPES)), with_results=False)
    bad = quality_report(run_suite(spark.createDataFrame(_clean(99), COLS),
                                   silver_suite(JIRA_EVENT_TYPES)), with_results=False)
    h = score_history(good.unionByName(bad)).collect()
    assert len(h) == 1 and h[0]["runs"] == 2 and h[0]["min_score_pct"] == 87.5
    assert h[0]["avg_score_pct"] == 93.8 and h[0]["checks_failed"] == 1
