"""Property tests on generated rows, each checked against a plain-Python
brute force of the same rule."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tidewater.functions.rules import JIRA_RULES
from tidewater.operators.decode import parse_event_time
from tidewater.operators.dedup import latest_per_key
from tidewater.operators.sessions import sessionize
from tidewater.operators.summary import team_measures
from tidewater.operators.validate import split_valid

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

JIRA_COLS = "rid int, event_id string, event_ts string, team_id string, user_id string, user_email string"
REASONS = ["missing event_id", "invalid timestamp", "missing team_id", "missing user_id",
           "missing email", "email too short"]

opt = lambda s: st.one_of(st.none(), s)
jira_row = st.tuples(
    opt(st.sampled_from(["e1", "e2", "e3"])),
    opt(st.sampled_from(["2024-01-01T10:00:00", "2024-01-01 10:00:00.5", "garbage", ""])),
    opt(st.just("team_1")),
    opt(st.just("user_1")),
    opt(st.text(alphabet="ab@.", min_size=0, max_size=6)),
)


def _expected_reason(r):
    event_id, ts, team, user, email = r
    parsed = ts is not None and ts not in ("garbage", "")
    for failed, reason in zip([event_id is None, not parsed, team is None, user is None,
                               email is None, email is not None and len(email) <= 3], REASONS):
        if failed:
            return reason
    return None


@SETTINGS
@given(st.lists(jira_row, min_size=1, max_size=25))
def test_valid_and_quarantine_partition_the_input(spark, data):
    df = parse_event_time(
        spark.createDataFrame([(i, *r) for i, r in enumerate(data)], JIRA_COLS), "event_ts")
    good, bad = split_valid(df, JIRA_RULES, stamp_col=None)
    good_ids = {r[0] for r in rows(good.select("rid"))}
    bad_ids = dict(rows(bad.select("rid", "quarantine_reason")))
    assert not good_ids & set(bad_ids)
    assert good_ids | set(bad_ids) == set(range(len(data)))
    for i, r in enumerate(data):
        assert bad_ids.get(i) == _expected_reason(r)


dedup_row = st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(0, 3))


@SETTINGS
@given(st.lists(dedup_row, min_size=1, max_size=40))
def test_latest_per_key_unique_exact_and_idempotent(spark, data):
    df = spark.createDataFrame([(k, t, b, i) for i, (k, t, b) in enumerate(data)],
                               "k int, t int, b int, rid int")
    order, ties = [F.col("t").desc()], [F.col("b").asc(), F.col("rid").asc()]
    once = latest_per_key(df, ["k"], order, ties)
    got = sorted(rows(once, ["k", "t", "b", "rid"]))
    want = {}
    for i, (k, t, b) in enumerate(data):
        cand = (k, t, b, i)
        if k not in want or (-t, b, i) < (-want[k][1], want[k][2], want[k][3]):
            want[k] = cand
    assert got == sorted(want.values())
    twice = latest_per_key(once, ["k"], order, ties)
    assert sorted(rows(twice, ["k", "t", "b", "rid"])) == got


BASE = dt.datetime(2024, 1, 1)
# offsets in seconds over ~5 hours, so keys span several one-hour buckets and
# many gaps fall near 30 minutes
event_offset = st.integers(0, 5 * 3600)


def _brute_sessions(events, gap_s=1800):
    out = []
    by_key = {}
    for k, s in events:
        by_key.setdefault(k, []).append(s)
    for k, ss in by_key.items():
        ss.sort()
        start = prev = ss[0]
        n = 1
        for s in ss[1:]:
            if s - prev <= gap_s:
                n += 1
            else:
                out.append((k, start, prev, n))
                start, n = s, 1
            prev = s
        out.append((k, start, prev, n))
    return sorted(out)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b"]), event_offset),
                min_size=1, max_size=60))
def test_two_level_sessions_equal_brute_force(spark, data):
    df = spark.createDataFrame([(k, BASE + dt.timedelta(seconds=s)) for k, s in data],
                               "k string, ts timestamp")
    for split in ("1 hour", "20 minutes"):
        got = sorted((k, int((a - BASE).total_seconds()), int((b - BASE).total_seconds()), n)
                     for k, a, b, n in rows(sessionize(df, ["k"], ts="ts", split=split),
                                            ["k", "session_start", "session_end",
                                             "events_in_session"]))
        assert got == _brute_sessions(data)


gold_row = st.tuples(st.sampled_from(["t1", "t2", "t3"]), st.booleans(),
                     st.integers(0, 1000), opt(st.integers(0, 5000)))


@SETTINGS
@given(st.lists(gold_row, min_size=1, max_size=40))
def test_gold_totals_equal_silver_totals(spark, data):
    df = spark.createDataFrame(
        [(t, f"name {t}", BASE, ai, c / 100.0, rt) for t, ai, c, rt in data],
        "team_id string, team_name string, event_ts timestamp, is_ai_event boolean, "
        "cost_estimate_usd double, response_time_ms int")
    m = team_measures(df)
    tot = m.agg(F.sum("total_events"), F.sum("ai_api_calls"), F.sum("total_cost_usd")).first()
    assert tot[0] == len(data)
    assert tot[1] == sum(1 for r in data if r[1])
    assert abs(tot[2] - sum(r[2] for r in data) / 100.0) < 1e-6
