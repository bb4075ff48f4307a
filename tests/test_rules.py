from pyspark.sql import functions as F

from conftest import rows
from tidewater.functions.rules import CONFLUENCE_RULES, JIRA_RULES
from tidewater.operators.decode import parse_event_time
from tidewater.operators.validate import split_valid

JIRA_COLS = "event_id string, event_ts string, team_id string, user_id string, user_email string"


def _jira(spark, data):
    return parse_event_time(spark.createDataFrame(data, JIRA_COLS), "event_ts")


def test_reason_per_rule_and_first_wins(spark):
    ts = "2024-01-01T10:00:00"
    df = _jira(spark, [
        ("ok", ts, "t", "u", "abcd@x"),          # valid
        (None, ts, "t", "u", "abcd@x"),          # missing event_id
        ("a", "garbage", "t", "u", "abcd@x"),    # invalid timestamp
        ("b", None, None, "u", "abcd@x"),        # both: first rule wins
        ("c", ts, None, "u", "abcd@x"),
        ("d", ts, "t", None, "abcd@x"),
        ("e", ts, "t", "u", None),               # NULL email
        ("f", ts, "t", "u", "a@b"),              # 3 characters
        ("g", ts, "t", "u", "ab@c"),             # 4 characters: valid
    ])
    good, bad = split_valid(df, JIRA_RULES, stamp_col=None)
    assert sorted(r[0] for r in rows(good.select("event_id"))) == ["g", "ok"]
    got = dict((r[0], r[1]) for r in rows(bad.select("event_id", "quarantine_reason")))
    assert got == {None: "missing event_id", "a": "invalid timestamp", "b": "invalid timestamp",
                   "c": "missing team_id", "d": "missing user_id", "e": "missing email",
                   "f": "email too short"}
    # valid + quarantined = input
    assert good.count() + bad.count() == df.count()


def test_confluence_rules(spark):
    df = spark.createDataFrame([
        ("1", "2024-01-01T00:00:00+00:00", "t", "u", "PLAT", "PAGE-1"),
        ("2", "2024-01-01T00:00:00+00:00", "t", "u", None, "PAGE-1"),
        ("3", "2024-01-01T00:00:00+00:00", "t", "u", "PLAT", None),
    ], "event_id string, event_ts string, team_id string, user_id string, space_key string, page_id string")
    df = parse_event_time(df, "event_ts")
    good, bad = split_valid(df, CONFLUENCE_RULES, stamp_col=None)
    assert [r[0] for r in rows(good.select("event_id"))] == ["1"]
    assert dict(rows(bad.select("event_id", "quarantine_reason"))) == {
        "2": "missing space_key", "3": "missing page_id"}


def test_time_parse_variants(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05.123456",), ("2024-01-02T03:04:05",),
                                ("2024-01-02T03:04:05.5+00:00",), ("garbage",), (None,), ("",)],
                               "event_ts string")
    out = [r[0] for r in rows(parse_event_time(df, "event_ts", ntz=True))]
    assert [o is None for o in out] == [False, False, False, True, True, True]
    assert out[0].microsecond == 123456 and out[2].microsecond == 500000


def test_valid_filter_is_pushed_to_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", "b", "c", "d", "eeee")],
                          "event_id string, event_ts string, team_id string, user_id string, "
                          "user_email string").write.parquet(path)
    good, _ = split_valid(spark.read.parquet(path), JIRA_RULES)
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_id)" in plan
    assert F is not None
