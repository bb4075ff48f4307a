"""Hand-written edge rows (FIXTURES.md): decode, join, sessions, late stream data."""

import datetime as dt
import time

from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from conftest import rows
from tidewater.functions.rules import Rule, RuleSet, not_null
from tidewater.operators.decode import decode_messages
from tidewater.operators.sessions import sessionize
from tidewater.operators.summary import team_cost_summary
from tidewater.operators.validate import split_valid
from tidewater.sources.stream import read_file_stream
from tidewater.streaming.ingest import await_all, start_append
from tidewater.streaming.silver import stream_sessions

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)
SCHEMA = StructType([StructField("event_id", StringType()),
                     StructField("response_time_ms", IntegerType()),
                     StructField("ai", BooleanType())])


def test_decode_edge_rows(spark):
    values = [
        (1, '{"event_id":"a","response_time_ms":5,"ai":true}'),        # valid object
        (2, "not json"), (3, None), (4, ""), (5, "[]"), (6, "{}"),    # nothing usable
        (7, '{"event_id":"b","response_time_ms":"fast","ai":false}'),  # one field mistyped
        (8, '{"event_id":"c","extra":1,"response_time_ms":7}'),        # extra field
        (9, '{"event_id":"d","response_time_ms":99999999999}'),        # int overflow
    ]
    msgs = spark.createDataFrame(values, "id int, value string")
    out = decode_messages(msgs.withColumn("value", F.col("value").cast("binary")), SCHEMA,
                          keep=["id"])
    got = {r[0]: tuple(r[1:]) for r in rows(out, ["id", "event_id", "response_time_ms", "ai"])}
    assert len(got) == len(values)                       # one row per message, none dropped
    assert got[1] == ("a", 5, True)
    for i in (2, 3, 4, 5, 6):
        assert got[i] == (None, None, None)
    assert got[7] == ("b", None, False)                  # the other fields survive
    assert got[8] == ("c", 7, None)
    assert got[9] == ("d", None, None)
    # the malformed payloads end in quarantine, as missing event_id
    rules = RuleSet([not_null("event_id"), Rule("missing ai", lambda: F.col("ai").isNotNull())])
    good, bad = split_valid(out, rules, stamp_col=None)
    reasons = dict(rows(bad.select("id", "quarantine_reason")))
    assert {i: reasons[i] for i in (2, 3, 4, 5, 6)} == {i: "missing event_id" for i in (2, 3, 4, 5, 6)}
    assert sorted(r[0] for r in rows(good.select("id"))) == [1, 7]


def test_two_names_for_one_team_id(spark):
    events = spark.createDataFrame([
        ("t1", "One", T0, True, 0.25, 100), ("t1", "Uno", T0, False, 0.0, 300),
    ], "team_id string, team_name string, event_ts timestamp, is_ai_event boolean, "
       "cost_estimate_usd double, response_time_ms int")
    teams = spark.createDataFrame([("t1", "One", "Eng", "Enterprise", 10.0, "EMEA")],
                                  "team_id string, team_name string, department string, "
                                  "plan_tier string, monthly_budget double, region string")
    got = {r["team_name"]: r.asDict() for r in team_cost_summary(events, teams, stamp=False).collect()}
    assert set(got) == {"One", "Uno"}                     # grouped by (team_id, team_name)
    assert got["Uno"]["department"] == "Eng"              # both rows get the team's metadata
    assert got["One"]["total_events"] == got["Uno"]["total_events"] == 1


def test_one_user_in_two_teams_has_separate_sessions(spark):
    m = dt.timedelta(minutes=1)
    df = spark.createDataFrame([
        ("u", "A", T0), ("u", "B", T0 + 5 * m), ("u", "A", T0 + 10 * m), ("u", "B", T0 + 50 * m),
    ], "user_id string, team_id string, event_ts timestamp_ntz")
    got = sorted(rows(sessionize(df, ["user_id", "team_id"]),
                      ["team_id", "session_start", "session_end", "events_in_session"]))
    assert got == [("A", T0, T0 + 10 * m, 2), ("B", T0 + 5 * m, T0 + 5 * m, 1),
                   ("B", T0 + 50 * m, T0 + 50 * m, 1)]


def test_late_events_and_the_watermark_in_stream_sessions(spark, tmp_path):
    """A late event within the watermark delay is always merged; one behind the
    watermark *may* be dropped (Spark guarantees only the former), so for it
    either outcome is accepted, but exactly one session is emitted."""
    m = dt.timedelta(minutes=1)
    land = tmp_path / "landing"
    batches = [
        [("u", T0), ("u", T0 + 5 * m), ("u", T0 + 120 * m)],                    # watermark -> 11:50
        [("u", T0 + 115 * m), ("u", T0 + 10 * m), ("u", T0 + 180 * m)],       # 11:55 within, 10:10 behind
    ]
    for i, data in enumerate(batches):
        (spark.createDataFrame(data, "user_id string, ts timestamp_ntz").coalesce(1)
         .write.parquet(str(land / f"batch{i}")))
        time.sleep(1.1)                                          # distinct file times
    src = read_file_stream(spark, f"{land}/batch*/*.parquet", "user_id string, ts timestamp_ntz",
                           max_files_per_trigger=1)
    q = start_append(stream_sessions(src, ["user_id"], ts="ts"), str(tmp_path / "out"),
                     str(tmp_path / "cp"), trigger={"availableNow": True})
    await_all([q])
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 2   # two micro-batches
    streamed = rows(spark.read.parquet(str(tmp_path / "out")),
                    ["session_start", "session_end", "events_in_session"])
    assert (T0 + 115 * m, T0 + 120 * m, 2) in streamed       # late but within the delay: merged
    first = [r for r in streamed if r[0] == T0]
    assert first in ([(T0, T0 + 5 * m, 2)], [(T0, T0 + 10 * m, 3)])
