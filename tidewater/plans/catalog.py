"""Query catalogue over the driver's test tables.

The operators are written for event feeds with teams, users and budgets; the
test tables are a TPC-H-like star plus an ``events`` table. The adapters below
map one onto the other (all derived by Spark from the whole tables):

* team        = nation (``team_id`` = n_nationkey, ``team_name`` = n_name)
* membership  = customer -> nation (``user_id`` = c_custkey)
* AI event    = ``event_type = 'purchase'``; cost = ``value`` of AI events;
  response time = ``floor(value * 10)`` as an integer (integral like the
  original feed's milliseconds, so averages are exact before rounding)
* budget      = 200 * n_nationkey (nation 0 has budget 0: the NULL guard)
* Jira-shaped message feed = every event serialised to JSON, with faults
  injected by the event's own ``props.k`` value (see :data:`FAULTS`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.rules import CONFLUENCE_RULES, JIRA_RULES
from tidewater.operators.audit import audit_counts
from tidewater.operators.decode import decode_messages, parse_event_time, stamp
from tidewater.operators.dedup import latest_per_key
from tidewater.operators.enrich import enrich_cost
from tidewater.operators.expectations import (quality_report, run_suite, score_history,
                                              silver_suite)
from tidewater.operators.sessions import average_session_by, sessionize
from tidewater.operators.summary import (monthly_team_cost, panel_spend_by_team, panel_totals,
                                         team_cost_summary, team_measures, top_spenders)
from tidewater.operators.validate import split_valid
from tidewater.plans.medallion import (Layout, run_gate, run_medallion, run_silver,
                                       stage_dimension)
from tidewater.schemas import AI_COST_PER_CALL_USD, CONFLUENCE_EVENT, JIRA_EVENT, REPORT
from tidewater.session import remove_path, scratch_path
from tidewater.sinks import overwrite_table, write_report
from tidewater.sources.lake import read_table
from tidewater.sources.stream import read_file_stream
from tidewater.streaming.ingest import await_all, bronze_stream, start_append
from tidewater.streaming.silver import silver_streams

# ---------------------------------------------------------------------------
# Fixed values of the adapters.
# ---------------------------------------------------------------------------
EVENT_TYPES = ("signup", "error", "click", "view", "purchase")
AI_TYPE = "purchase"
BUDGET_PER_NATIONKEY = 200
PLANNED_TEAM_BASE = 100   # ids of planned teams, beyond every nation's
ENTERPRISE_BELOW_NATIONKEY = 10
FLAGSHIP_COST_TIERS = (5000.0, 3000.0)
MONTHLY_COST_TIERS = (500000.0, 250000.0)
URGENT_PRIORITY = "1-URGENT"
PAGE_TS_FORMAT = "'2024-01-01T'HH:mm:ss.SSSSSS"
TS_TEXT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# props.k value -> injected fault of the message feed
FAULTS = {
    0: "payload is not JSON",
    1: "event_ts is unparsable text",
    2: "team_id missing",
    3: "user_id missing",
    4: "user_email missing",
    5: "user_email of 3 characters",
    6: "event_ts and team_id missing (first reason wins)",
    8: "response_time_ms of the wrong JSON type",
    9: "message delivered twice",
    10: "unknown event_type",
    11: "negative response_time_ms",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team dimension: nation joined with region."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("n_nationkey").alias("team_id"),
                    F.col("n_name").alias("team_name"),
                    F.concat(F.lit("DEPT_"), F.col("n_regionkey").cast("string")).alias("department"),
                    F.when(F.col("n_nationkey") < ENTERPRISE_BELOW_NATIONKEY, "Enterprise")
                    .otherwise("Business").alias("plan_tier"),
                    (F.col("n_nationkey") * BUDGET_PER_NATIONKEY).cast("decimal(10,2)")
                    .alias("monthly_budget"),
                    F.col("r_name").alias("region")))


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id -> (team_id, team_name)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
            .select(F.col("c_custkey").alias("user_id"), F.col("n_nationkey").alias("team_id"),
                    F.col("n_name").alias("team_name")))


def response_ms(value: str = "value"):
    """Integer response time derived from a 2-decimal amount (tenths, floored).

    Integers keep sums exact, so averages round the same in every engine."""
    return F.floor(F.col(value) * 10).cast("int")


def priced_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events + is_ai_event + cost_estimate_usd (= value of AI events)."""
    e = table(spark, sf_dir, "events")
    return enrich_cost(e, is_ai=F.col("event_type") == AI_TYPE, rate=F.col("value"),
                       stamp_col=None)


def timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """priced events + response_time_ms."""
    return priced_events(spark, sf_dir).withColumn("response_time_ms", response_ms())


def planned_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A team per region that has no members yet, shaped like :func:`teams`."""
    key = F.col("r_regionkey")
    return table(spark, sf_dir, "region").select(
        (key + PLANNED_TEAM_BASE).alias("team_id"), F.concat(F.lit("PLANNED_"), "r_name").alias("team_name"),
        F.concat(F.lit("DEPT_"), key.cast("string")).alias("department"), F.lit("Business").alias("plan_tier"),
        (key * BUDGET_PER_NATIONKEY).cast("decimal(10,2)").alias("monthly_budget"), F.col("r_name").alias("region"))


def _gold(spark: SparkSession, sf_dir: str, keep: str = "events", dimension: DataFrame | None = None) -> DataFrame:
    return team_cost_summary(timed_events(spark, sf_dir), teams(spark, sf_dir) if dimension is None else dimension, keep=keep,
                             members=members(spark, sf_dir), member_key="user_id",
                             response_time="response_time_ms", ts="ts",
                             cost_tiers=FLAGSHIP_COST_TIERS, stamp=False)


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped ``(key, value)`` feed: each event as a Jira-shaped JSON
    object, faults injected per :data:`FAULTS`."""
    return messages_of(table(spark, sf_dir, "events"), members(spark, sf_dir)).drop("delivery")


def _fault_key():
    # one JSON read per event; a separate projection that Catalyst does not
    # inline into the many branches that test it
    return F.get_json_object("props", "$.k").cast("int")


def _deliveries(e: DataFrame) -> DataFrame:
    """A row per delivery (1, for fault 9 also 2) of each event, with its fault key ``_k``."""
    e = e.withColumn("_k", _fault_key())
    times = F.when(F.col("_k") == 9, 2).otherwise(1)
    return e.withColumn("delivery", F.explode(F.sequence(F.lit(1), times)))


def messages_of(e: DataFrame, m: DataFrame, changed: bool = False) -> DataFrame:
    """The message feed ``(key, value, delivery)`` of an events frame (batch or
    streaming) and a static membership frame. With ``changed`` a second delivery
    differs from the first: its response time is one more."""
    e = _deliveries(e)
    k = F.col("_k")
    rt = response_ms() + (F.col("delivery") - 1 if changed else F.lit(0))
    uid = F.col("user_id").cast("string")
    payload = F.struct(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(k == 10, F.lit("unknown")).otherwise(F.col("event_type")).alias("event_type"),
        F.when(k == 1, F.lit("garbage")).when(k == 6, F.lit(None))
        .otherwise(F.date_format("ts", TS_TEXT_FORMAT)).alias("event_ts"),
        F.when(k.isin(2, 6), F.lit(None))
        .otherwise(F.concat(F.lit("team_"), F.col("team_id").cast("string"))).alias("team_id"),
        F.col("team_name"),
        F.when(k == 3, F.lit(None)).otherwise(F.concat(F.lit("user_"), uid)).alias("user_id"),
        F.when(k == 4, F.lit(None)).when(k == 5, F.lit("a@b"))
        .otherwise(F.concat(F.lit("user"), uid, F.lit("@example.com"))).alias("user_email"),
        F.when(k == 11, F.lit(-1)).otherwise(rt).alias("response_time_ms"),
        (F.col("event_type") == AI_TYPE).alias("ai_assist_used"),
        F.lit("events").alias("source_app"),
    )
    js = F.to_json(payload)
    js = F.when(k == 8, F.regexp_replace(js, '"response_time_ms":-?[0-9]+',
                                         '"response_time_ms":"fast"')).otherwise(js)
    value = F.when(k == 0, F.lit("not json")).otherwise(js)
    return e.join(m, "user_id", "left").select(
        F.col("event_id").cast("string").alias("key"), value.cast("binary").alias("value"), "delivery")


def _ingested(decoded: DataFrame) -> DataFrame:
    """The ingest stamp; a second delivery comes a minute after the first."""
    minutes = F.make_dt_interval(mins=F.col("delivery") - 1)
    return (stamp(decoded, "ingested_at")
            .withColumn("ingested_at", F.col("ingested_at") + minutes).drop("delivery"))


def bronze_events(spark: SparkSession, sf_dir: str, changed: bool = False) -> DataFrame:
    """Decoded message feed with its ingest stamp (the Bronze table)."""
    msgs = messages_of(table(spark, sf_dir, "events"), members(spark, sf_dir), changed)
    return _ingested(decode_messages(msgs, JIRA_EVENT, keep=["delivery"]))


def typed_bronze(spark: SparkSession, sf_dir: str, changed: bool = False) -> DataFrame:
    return parse_event_time(bronze_events(spark, sf_dir, changed), "event_ts", ntz=True)


def latest_event(valid: DataFrame) -> DataFrame:
    """The last delivery of each event; a content hash closes the order."""
    return latest_per_key(valid, ["event_id"], [F.col("ingested_at").desc()],
                          [F.xxhash64(*valid.columns).desc()])


def silver_events(spark: SparkSession, sf_dir: str, stamp_col: str | None = None) -> DataFrame:
    valid, _ = split_valid(typed_bronze(spark, sf_dir, changed=True), JIRA_RULES)
    latest = latest_event(valid)
    return enrich_cost(latest, is_ai=F.col("event_type") == AI_TYPE,
                       rate=AI_COST_PER_CALL_USD, stamp_col=stamp_col).drop("ingested_at")


# ---------------------------------------------------------------------------
# The second feed: Confluence-shaped page events (times carry "+00:00").
# ---------------------------------------------------------------------------
# props.k value -> injected fault of the page-event feed
CONFLUENCE_FAULTS = {
    0: "payload is not JSON",
    1: "event_ts is unparsable text",
    2: "team_id missing",
    3: "user_id missing",
    4: "space_key missing",
    5: "page_id missing",
    6: "space_key and page_id missing (first reason wins)",
    9: "message delivered twice",
}


def page_messages_of(e: DataFrame, m: DataFrame) -> DataFrame:
    """Kafka-shaped page-event feed: space = first four letters of the event
    type, page = the event's ``props.k`` modulo 4, users in two groups, and all
    times on one day, so that a user comes back to a page within a session;
    faults per :data:`CONFLUENCE_FAULTS`."""
    e = _deliveries(e).withColumn("_group", F.col("user_id") % 2)
    k = F.col("_k")
    uid = F.col("user_id").cast("string")
    payload = F.struct(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("event_type"),
        F.when(k == 1, F.lit("garbage"))
        .otherwise(F.concat(F.date_format("ts", PAGE_TS_FORMAT), F.lit("+00:00"))).alias("event_ts"),
        F.when(k == 2, F.lit(None))
        .otherwise(F.concat(F.lit("team_"), F.col("team_id").cast("string"))).alias("team_id"),
        F.col("team_name"),
        F.when(k == 3, F.lit(None)).otherwise(F.concat(F.lit("user_"), F.col("_group").cast("string"))).alias("user_id"),
        F.concat(F.lit("user"), uid, F.lit("@example.com")).alias("user_email"),
        F.when(k.isin(4, 6), F.lit(None))
        .otherwise(F.upper(F.substring("event_type", 1, 4))).alias("space_key"),
        F.when(k.isin(5, 6), F.lit(None))
        .otherwise(F.concat(F.lit("PAGE-"), (k % 4).cast("string"))).alias("page_id"),
        F.concat(F.lit("Page "), k.cast("string")).alias("page_title"),
        response_ms().alias("response_time_ms"),
        (F.col("event_type") == AI_TYPE).alias("ai_assist_used"),
        F.lit("confluence").alias("source_app"),
    )
    value = F.when(k == 0, F.lit("not json")).otherwise(F.to_json(payload))
    return e.join(m, "user_id", "left").select(
        F.col("event_id").cast("string").alias("key"), value.cast("binary").alias("value"), "delivery")


def typed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_event_time(bronze_pages(spark, sf_dir), "event_ts", ntz=True)


def bronze_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = page_messages_of(table(spark, sf_dir, "events"), members(spark, sf_dir))
    return _ingested(decode_messages(msgs, CONFLUENCE_EVENT, keep=["delivery"]))


# ---------------------------------------------------------------------------
# Registered queries: (spark, sf_dir) -> DataFrame; no processing-time stamps.
# ---------------------------------------------------------------------------

def q_team_cost_summary(spark, sf_dir):
    return _gold(spark, sf_dir)


def q_team_cost_summary_all_teams(spark, sf_dir):
    return _gold(spark, sf_dir, keep="teams")


def q_team_cost_quiet_teams(spark, sf_dir):
    """All teams, of which those without members have no events: their measures are zero."""
    every = teams(spark, sf_dir).unionByName(planned_teams(spark, sf_dir))
    return _gold(spark, sf_dir, keep="teams", dimension=every)


def q_team_cost_monthly(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("ts"),
        F.col("o_totalprice").alias("price"), F.floor("o_totalprice").cast("int").alias("rt"),
        (F.col("o_orderpriority") == URGENT_PRIORITY).alias("is_ai_event"))
    o = enrich_cost(o, is_ai=F.col("is_ai_event"), rate=F.col("price"), stamp_col=None)
    return monthly_team_cost(o, teams(spark, sf_dir), ts="ts", members=members(spark, sf_dir),
                             member_key="user_id", response_time="rt",
                             cost_tiers=MONTHLY_COST_TIERS, stamp=False)


def q_team_cost_top(spark, sf_dir):
    return top_spenders(_gold(spark, sf_dir), 20)


def q_panel_totals(spark, sf_dir):
    return panel_totals(_gold(spark, sf_dir))


def q_panel_spend_by_team(spark, sf_dir):
    return panel_spend_by_team(_gold(spark, sf_dir))


def q_decode_events(spark, sf_dir):
    return decode_messages(event_messages(spark, sf_dir), JIRA_EVENT)


def q_quarantine(spark, sf_dir):
    _, bad = split_valid(typed_bronze(spark, sf_dir), JIRA_RULES, stamp_col=None)
    return bad.drop("ingested_at")


def q_valid_events(spark, sf_dir):
    return silver_events(spark, sf_dir)


def q_silver_audit_events(spark, sf_dir):
    return audit_counts(typed_bronze(spark, sf_dir), ["event_id"], JIRA_RULES.valid())


def q_latest_per_key(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return latest_per_key(li, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc()],
                          [F.col("l_partkey").asc(), F.col("l_suppkey").asc()])


def q_silver_audit(spark, sf_dir):
    return audit_counts(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_enrich_events(spark, sf_dir):
    return priced_events(spark, sf_dir)


def q_user_sessions(spark, sf_dir):
    return sessionize(table(spark, sf_dir, "events"), ["user_id"], ts="ts")


def q_user_page_sessions(spark, sf_dir):
    return sessionize(table(spark, sf_dir, "events"), ["user_id", "event_type"], ts="ts")


def q_silver_user_sessions(spark, sf_dir):
    """Sessions of the cleaned, de-duplicated feed keyed like the original job
    (user, team, team name)."""
    return sessionize(silver_events(spark, sf_dir), ["user_id", "team_id", "team_name"])


def q_confluence_quarantine(spark, sf_dir):
    _, bad = split_valid(typed_pages(spark, sf_dir), CONFLUENCE_RULES, stamp_col=None)
    return bad.drop("ingested_at")


def clean_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid, de-duplicated page events (still carrying the ingest stamp)."""
    valid, _ = split_valid(typed_pages(spark, sf_dir), CONFLUENCE_RULES)
    return latest_event(valid)


PAGE_SESSION_KEYS = ("user_id", "team_id", "team_name", "space_key", "page_id")


def q_confluence_valid_events(spark, sf_dir):
    """Silver of the page-event feed: valid, de-duplicated, flagged and priced."""
    return enrich_cost(clean_pages(spark, sf_dir), is_ai=F.col("event_type") == AI_TYPE,
                       rate=AI_COST_PER_CALL_USD, stamp_col=None).drop("ingested_at")


def q_confluence_page_sessions(spark, sf_dir):
    """Sessions per user and page of the cleaned page-event feed."""
    return sessionize(clean_pages(spark, sf_dir), PAGE_SESSION_KEYS)


def q_avg_session_by_team(spark, sf_dir):
    s = sessionize(table(spark, sf_dir, "events"), ["user_id"], ts="ts")
    return average_session_by(s, members(spark, sf_dir), "user_id", ["team_id", "team_name"])


def clean_suite():
    return silver_suite(EVENT_TYPES, response_time="value")


def q_expectations(spark, sf_dir):
    return run_suite(priced_events(spark, sf_dir), clean_suite()).drop("rows_checked")


def failing_silver(spark, sf_dir):
    """The message feed typed and priced but neither split nor deduplicated."""
    return enrich_cost(typed_bronze(spark, sf_dir), is_ai=F.col("event_type") == AI_TYPE,
                       stamp_col=None)


def q_expectations_failing(spark, sf_dir):
    return run_suite(failing_silver(spark, sf_dir), silver_suite(EVENT_TYPES)).drop("rows_checked")


def q_quality_score(spark, sf_dir):
    res = run_suite(failing_silver(spark, sf_dir), silver_suite(EVENT_TYPES))
    return quality_report(res, with_results=False, stamp=False)


def q_quality_history(spark, sf_dir):
    """Quality score over time (EXT-6): two gate runs, one over the clean feed
    and one over the faulty message feed, append their reports to one report
    table below the shared root; the history is a ``groupBy`` over the appended
    reports. The run day (``period``) is left out of the compared output."""
    path = scratch_path(spark, "quality_history")
    for feed, suite in ((priced_events(spark, sf_dir), clean_suite()),
                        (failing_silver(spark, sf_dir), silver_suite(EVENT_TYPES))):
        write_report(quality_report(run_suite(feed, suite, stamp=True)), path)
    return score_history(read_table(spark, path, "json", schema=REPORT)).drop("period")


# unit costs and budgets of the whole run, by team number: every tier and status occurs
RUN_RATES = (0.002, 0.01, 0.05)
RUN_BUDGETS = (0.0, 0.5, 4.0, 1.0, 100.0)


def _pick(values, number):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int"))


def feed_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The team dimension keyed like the message feed (``team_<n>``)."""
    budget = _pick(RUN_BUDGETS, F.col("team_id")).cast("decimal(10,2)")
    return (teams(spark, sf_dir).withColumn("monthly_budget", budget)
            .withColumn("team_id", F.concat(F.lit("team_"), F.col("team_id").cast("string"))))


def run_options() -> dict:
    number = F.substring_index("team_id", "_", -1).cast("int")
    return {"is_ai": F.col("event_type") == AI_TYPE, "ntz": True, "rate": _pick(RUN_RATES, number),
            "tie_breakers": [F.col("response_time_ms").desc()]}


def written_bronze(spark: SparkSession, base: str, bronze: DataFrame) -> DataFrame:
    overwrite_table(bronze, f"{base}/bronze")
    return read_table(spark, f"{base}/bronze")


def q_medallion_gold(spark, sf_dir):
    """Gold of the whole run (decision D3) on the faulty message feed with the
    eight checks, read back (creation stamp excluded): Bronze is written, then
    quarantine, Silver and sessions, the quality gate over Silver, and Gold. The
    feed's faults that no validity rule removes (an unknown type, response times
    of -1 and above 5000 ms) fail the gate, so the gate runs in report mode
    here; blocking mode is covered by ``test_medallion_gate_blocks_gold``."""
    base = scratch_path(spark, "medallion")
    res = run_medallion(spark, written_bronze(spark, base, bronze_events(spark, sf_dir, changed=True)),
                        feed_teams(spark, sf_dir), f"{base}/lake", suite=silver_suite(EVENT_TYPES),
                        enforce_gate=False, silver_options=run_options())
    for done in (f"{base}/bronze", res["silver"], res["quarantine"], res["sessions"]):
        remove_path(spark, done)
    return read_table(spark, res["gold"]).drop("gold_created_at")


def silver_run(spark: SparkSession, sf_dir: str, name: str) -> Layout:
    """Silver of the message feed, without the later layers."""
    base = scratch_path(spark, name)
    out = Layout(f"{base}/lake")
    run_silver(spark, written_bronze(spark, base, bronze_events(spark, sf_dir, changed=True)), out,
               **run_options())
    remove_path(spark, f"{base}/bronze")
    return out


def q_medallion_quality(spark, sf_dir):
    """The gate's result rows for the Silver table of the run, read back from
    the appended report (check time excluded)."""
    out = silver_run(spark, sf_dir, "medallion_quality")
    return run_gate(spark, out, silver_suite(EVENT_TYPES), enforce_gate=False).drop("timestamp")


def q_medallion_audit(spark, sf_dir):
    """The audit row of the run: all six counters."""
    return read_table(spark, silver_run(spark, sf_dir, "medallion_audit").audit)


def q_confluence_medallion_sessions(spark, sf_dir):
    """Page sessions of the second feed's run, read back."""
    base = scratch_path(spark, "confluence_medallion")
    out = Layout(f"{base}/lake")
    run_silver(spark, written_bronze(spark, base, bronze_pages(spark, sf_dir)), out, rules=CONFLUENCE_RULES,
               session_keys=PAGE_SESSION_KEYS,
               **(run_options() | {"rate": AI_COST_PER_CALL_USD}))
    remove_path(spark, f"{base}/bronze")
    return read_table(spark, out.sessions)


def q_team_cost_unknown_members(spark, sf_dir):
    """Gold where some users have no membership: their events stay, without a team."""
    known = members(spark, sf_dir).filter(F.col("user_id") % 7 != 3)
    return team_cost_summary(timed_events(spark, sf_dir), teams(spark, sf_dir), members=known,
                             member_key="user_id", ts="ts", cost_tiers=FLAGSHIP_COST_TIERS, stamp=False)


def q_team_cost_rounding_ties(spark, sf_dir):
    """Teams of 75 flagged events each, whose total lies on a rounding tie of the
    fifth decimal at the fixed unit cost."""
    e = table(spark, sf_dir, "events").withColumn("response_time_ms", response_ms())
    e = e.withColumn("team_id", F.floor(F.col("event_id") / 75)).withColumn("team_name", F.lit("T"))
    return team_measures(enrich_cost(e, is_ai=F.lit(True), stamp_col=None), ts="ts")


def q_staged_dimensions(spark, sf_dir):
    """Staging snapshots of three dimensions with their provenance, read back."""
    base = scratch_path(spark, "staging")
    out = None
    for name, key, text in (("customer", "c_custkey", "c_name"), ("nation", "n_nationkey", "n_name"),
                            ("region", "r_regionkey", "r_name")):
        stage_dimension(table(spark, sf_dir, name), f"testdata_{name}", f"{base}/{name}")
        staged = read_table(spark, f"{base}/{name}").select(
            F.lit(name).alias("dimension"), F.col(key).cast("long").alias("key"), F.col(text).alias("name"),
            "source", F.col("extracted_at").isNotNull().alias("stamped"))
        out = staged if out is None else out.unionByName(staged)
    return out


# ---------------------------------------------------------------------------
# Streaming queries: run to completion with an availableNow trigger into
# checkpointed sinks below the shared root, then read the sink back.
# ---------------------------------------------------------------------------
def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return read_file_stream(spark, f"{sf_dir.rstrip('/')}/events*.parquet", schema)


def _drain(spark, name: str, streams: dict) -> dict:
    base = scratch_path(spark, name)
    qs, paths = [], {}
    for label, sdf in streams.items():
        paths[label] = f"{base}/{label}"
        qs.append(start_append(sdf, paths[label], f"{base}/_checkpoints/{label}",
                               trigger={"availableNow": True}))
    await_all(qs)
    remove_path(spark, f"{base}/_checkpoints")
    return paths


def q_stream_ingest(spark, sf_dir):
    msgs = messages_of(events_stream(spark, sf_dir), members(spark, sf_dir))
    paths = _drain(spark, "stream_ingest", {"bronze": bronze_stream(msgs, JIRA_EVENT)})
    return spark.read.parquet(paths["bronze"]).drop("ingested_at")


def q_stream_ingest_both(spark, sf_dir):
    """Both feeds ingested by two concurrent checkpointed queries (STR-3);
    ``await_all`` raises if either of them fails. Returns both Bronze tables with
    their times parsed and a feed column (ingest stamps excluded)."""
    m = members(spark, sf_dir)
    paths = _drain(spark, "stream_ingest_both", {
        "jira": bronze_stream(messages_of(events_stream(spark, sf_dir), m), JIRA_EVENT),
        "confluence": bronze_stream(page_messages_of(events_stream(spark, sf_dir), m), CONFLUENCE_EVENT)})
    feeds = [parse_event_time(spark.read.parquet(path), "event_ts", ntz=True)
             .withColumn("feed", F.lit(name)) for name, path in paths.items()]
    return feeds[0].unionByName(feeds[1], allowMissingColumns=True).drop("ingested_at")


def typed_stream(spark: SparkSession, sf_dir: str, events: DataFrame) -> DataFrame:
    msgs = messages_of(events, members(spark, sf_dir))
    return parse_event_time(bronze_stream(msgs, JIRA_EVENT), "event_ts", ntz=True)


def _stream_silver(spark, sf_dir, name, events):
    silver, _ = silver_streams(typed_stream(spark, sf_dir, events), JIRA_RULES,
                               is_ai=F.col("event_type") == AI_TYPE)
    paths = _drain(spark, name, {"silver": silver})
    return spark.read.parquet(paths["silver"]).drop("ingested_at", "silver_processed_at")


def q_stream_silver(spark, sf_dir):
    return _stream_silver(spark, sf_dir, "stream_silver", events_stream(spark, sf_dir))


STREAM_FILES = 6
FILES_PER_STEP = 4   # a trigger takes one step's files


def landed_events(spark: SparkSession, sf_dir: str) -> str:
    """The events as files that arrive one by one, each from the whole time
    span; a fault-9 event is in the next file too."""
    path = scratch_path(spark, "landing")
    e = table(spark, sf_dir, "events")
    turn, again = F.pmod("event_id", F.lit(STREAM_FILES)), _fault_key() == 9
    for i in range(STREAM_FILES):
        here = (turn == i) | (again & (turn == i - 1))
        e.filter(here).repartition(FILES_PER_STEP).write.mode("append").parquet(path)
    return path


def q_stream_silver_batches(spark, sf_dir):
    """Streaming Silver over six micro-batches in shuffled time order: no valid
    row may be lost behind a watermark."""
    path = landed_events(spark, sf_dir)
    src = read_file_stream(spark, path, table(spark, sf_dir, "events").schema, max_files_per_trigger=FILES_PER_STEP)
    return _stream_silver(spark, sf_dir, "stream_silver_batches", src)


def q_stream_quarantine(spark, sf_dir):
    """The stateless quarantine stream: every invalid message with its reason,
    as in the batch form (stamps excluded)."""
    _, bad = silver_streams(typed_stream(spark, sf_dir, events_stream(spark, sf_dir)), JIRA_RULES)
    paths = _drain(spark, "stream_quarantine", {"quarantine": bad})
    return spark.read.parquet(paths["quarantine"]).drop("ingested_at", "quarantined_at")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "team_cost_summary": q_team_cost_summary,
    "team_cost_summary_all_teams": q_team_cost_summary_all_teams,
    "team_cost_quiet_teams": q_team_cost_quiet_teams,
    "team_cost_monthly": q_team_cost_monthly,
    "team_cost_unknown_members": q_team_cost_unknown_members,
    "team_cost_rounding_ties": q_team_cost_rounding_ties,
    "staged_dimensions": q_staged_dimensions,
    "team_cost_top": q_team_cost_top,
    "panel_totals": q_panel_totals,
    "panel_spend_by_team": q_panel_spend_by_team,
    "decode_events": q_decode_events,
    "quarantine": q_quarantine,
    "valid_events": q_valid_events,
    "silver_audit_events": q_silver_audit_events,
    "latest_per_key": q_latest_per_key,
    "silver_audit": q_silver_audit,
    "enrich_events": q_enrich_events,
    "user_sessions": q_user_sessions,
    "user_page_sessions": q_user_page_sessions,
    "avg_session_by_team": q_avg_session_by_team,
    "silver_user_sessions": q_silver_user_sessions,
    "confluence_quarantine": q_confluence_quarantine,
    "confluence_valid_events": q_confluence_valid_events,
    "confluence_page_sessions": q_confluence_page_sessions,
    "expectations": q_expectations,
    "expectations_failing": q_expectations_failing,
    "quality_score": q_quality_score,
    "quality_history": q_quality_history,
    "medallion_gold": q_medallion_gold,
    "medallion_quality": q_medallion_quality,
    "medallion_audit": q_medallion_audit,
    "confluence_medallion_sessions": q_confluence_medallion_sessions,
    "stream_ingest": q_stream_ingest,
    "stream_ingest_both": q_stream_ingest_both,
    "stream_silver": q_stream_silver,
    "stream_silver_batches": q_stream_silver_batches,
    "stream_quarantine": q_stream_quarantine,
}
