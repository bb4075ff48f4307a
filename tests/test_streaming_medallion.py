import os
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidewater.operators.expectations import QualityGateError, silver_suite
from tidewater.plans.catalog import AI_TYPE, event_messages, messages_of, members
from tidewater.plans.medallion import run_medallion, stage_dimension
from tidewater.schemas import JIRA_EVENT
from tidewater.sinks import Lake
from tidewater.sources.lake import read_table
from tidewater.streaming.ingest import await_all, bronze_stream, start_append
from tidewater.streaming.silver import stream_sessions


def _copy_events(dst_dir, name):
    os.makedirs(dst_dir, exist_ok=True)
    shutil.copy(f"{SF_SMALL}/events.parquet", f"{dst_dir}/{name}")


def test_stream_restart_adds_nothing_and_new_file_adds_its_rows(spark, tmp_path):
    land = str(tmp_path / "landing")
    _copy_events(land, "events-1.parquet")
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    out, cp = str(tmp_path / "bronze"), str(tmp_path / "cp")

    def run():
        src = spark.readStream.schema(schema).parquet(f"{land}/events-*.parquet")
        msgs = messages_of(src, members(spark, SF_SMALL))
        q = start_append(bronze_stream(msgs, JIRA_EVENT), out, cp, trigger={"availableNow": True})
        await_all([q])
        return spark.read.parquet(out).count()

    first = run()
    assert first == event_messages(spark, SF_SMALL).count()
    assert run() == first                      # rerun without new files: nothing repeated
    _copy_events(land, "events-2.parquet")
    assert run() == 2 * first                  # a new file adds exactly its rows


def test_stream_sessions_are_a_subset_of_batch(spark, tmp_path):
    from tidewater.operators.sessions import sessionize
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    src = spark.readStream.schema(schema).parquet(f"{SF_SMALL}/events*.parquet")
    q = start_append(stream_sessions(src, ["user_id"], ts="ts"), str(tmp_path / "s"),
                     str(tmp_path / "cp"), trigger={"availableNow": True})
    await_all([q])
    streamed = spark.read.parquet(str(tmp_path / "s"))
    batch = sessionize(spark.read.parquet(f"{SF_SMALL}/events.parquet"), ["user_id"], ts="ts")
    assert streamed.exceptAll(batch).count() == 0
    assert 0 < batch.count() - streamed.count() <= 2   # only sessions still open at the end


def _bronze_and_teams(spark, tmp_path):
    bronze = event_messages(spark, SF_SMALL)
    from tidewater.operators.decode import decode_messages, stamp
    path = str(tmp_path / "bronze")
    stamp(decode_messages(bronze, JIRA_EVENT), "ingested_at").write.parquet(path)
    n = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    teams = n.select(F.concat(F.lit("team_"), F.col("n_nationkey").cast("string")).alias("team_id"),
                     F.col("n_name").alias("team_name"), F.lit("Eng").alias("department"),
                     F.lit("Business").alias("plan_tier"),
                     F.lit(5000).cast("decimal(10,2)").alias("monthly_budget"),
                     F.lit("EMEA").alias("region"))
    stage_dimension(teams, "fixture_teams", str(tmp_path / "staging_teams"))
    return read_table(spark, path), read_table(spark, str(tmp_path / "staging_teams"))


def test_medallion_gate_blocks_gold(spark, tmp_path):
    bronze, teams = _bronze_and_teams(spark, tmp_path)
    root = str(tmp_path / "lake")
    with pytest.raises(QualityGateError):
        run_medallion(spark, bronze, teams, root,
                      suite=silver_suite(("signup", "error", "click", "view", "purchase")),
                      silver_options={"is_ai": F.col("event_type") == AI_TYPE, "tie_breakers": []})
    assert not os.path.exists(f"{root}/gold")
    assert os.path.exists(f"{root}/silver") and os.path.exists(f"{root}/quality_reports")


def test_medallion_end_to_end(spark, tmp_path):
    bronze, teams = _bronze_and_teams(spark, tmp_path)
    root = str(tmp_path / "lake")
    suite = silver_suite(("signup", "error", "click", "view", "purchase", "unknown"),
                         bounds=(-1, 5000), min_rows=100)
    res = run_medallion(spark, bronze, teams, root, suite=suite,
                        silver_options={"is_ai": F.col("event_type") == AI_TYPE, "tie_breakers": []})
    a = res["audit"]
    assert a["rows_in"] == bronze.count()
    assert a["rows_quarantined"] + a["rows_valid"] == a["rows_in"]
    assert a["duplicates_removed"] > 0 and a["rows_out"] == a["rows_valid"] - a["duplicates_removed"]
    silver = spark.read.parquet(res["silver"])
    assert silver.select("event_id").distinct().count() == silver.count() == a["rows_out"]
    gold = spark.read.parquet(res["gold"])
    assert gold.agg(F.sum("total_events")).first()[0] == a["rows_out"]
    assert gold.filter(F.col("department").isNull()).count() == 0
    sessions = spark.read.parquet(res["sessions"])
    assert sessions.agg(F.sum("events_in_session")).first()[0] == a["rows_out"]
    assert a["sessions"] == sessions.count()


def test_silver_partitioned_by_event_date_prunes(spark, tmp_path):
    from tidewater.plans.medallion import Layout, run_silver
    bronze, _ = _bronze_and_teams(spark, tmp_path)
    out = Layout(str(tmp_path / "lake"))
    a = run_silver(spark, bronze, out, is_ai=F.col("event_type") == AI_TYPE, tie_breakers=[],
                   date_partition="event_date")
    folders = Lake(spark, out.silver).state()["tables"]["data"]["folders"]
    assert len(folders) > 1 and all("/event_date=" in f for f in folders)
    silver = read_table(spark, out.silver)
    assert silver.count() == a["rows_out"]
    day = silver.select(F.min("event_date")).first()[0]
    one_day = silver.filter(F.col("event_date") == F.lit(day))
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert one_day.count() == silver.filter(F.to_date("event_ts") == F.lit(day)).count()


def test_medallion_report_mode_writes_gold_and_records_failures(spark, tmp_path):
    bronze, teams = _bronze_and_teams(spark, tmp_path)
    root = str(tmp_path / "lake")
    res = run_medallion(spark, bronze, teams, root,
                        suite=silver_suite(("signup", "error", "click", "view", "purchase")),
                        silver_options={"is_ai": F.col("event_type") == AI_TYPE, "tie_breakers": []},
                        enforce_gate=False)
    failed = {r["check"] for r in res["gate"].filter(F.col("status") == "FAILED").collect()}
    assert "event_type_valid_values" in failed            # the injected unknown type
    assert os.path.exists(f"{root}/gold")
    assert read_table(spark, res["gold"]).count() > 0


def test_stream_silver_loses_no_row_over_micro_batches(spark):
    """Six micro-batches in shuffled time order: what isn't in Silver
    is in quarantine or a duplicate, as in the batch form."""
    from tidewater.plans.catalog import (FILES_PER_STEP, QUERIES, landed_events, members as team_of,
                                          silver_events)
    silver = QUERIES["stream_silver_batches"](spark, SF_SMALL)
    assert silver.count() == silver_events(spark, SF_SMALL).count()
    landed = spark.read.parquet(landed_events(spark, SF_SMALL))
    assert len(landed.inputFiles()) == 6 * FILES_PER_STEP
    from tidewater.functions.rules import JIRA_RULES
    from tidewater.operators.decode import decode_messages, parse_event_time
    from tidewater.operators.validate import split_valid
    msgs = decode_messages(messages_of(landed, team_of(spark, SF_SMALL)), JIRA_EVENT)
    valid, bad = split_valid(parse_event_time(msgs, "event_ts", ntz=True), JIRA_RULES)
    copies = valid.count() - valid.select("event_id").distinct().count()
    assert copies > 0 and silver.count() + bad.count() + copies == msgs.count()


def test_gate_reads_only_recent_reports(spark, tmp_path):
    from tidewater.plans.medallion import Layout, run_gate, run_silver
    bronze, _ = _bronze_and_teams(spark, tmp_path)
    out = Layout(str(tmp_path / "lake"))
    run_silver(spark, bronze, out, tie_breakers=[])
    checks = run_gate(spark, out, silver_suite(("signup", "error", "click", "view", "purchase")), enforce_gate=False)
    plan = checks._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan and checks.count() == 8


def test_medallion_reaches_every_tier_and_status(spark):
    from tidewater.plans.catalog import q_medallion_gold
    gold = q_medallion_gold(spark, "/root/testdata/sf0.01").collect()
    assert {r["cost_tier"] for r in gold} == {"HIGH", "MEDIUM", "LOW"}
    assert {r["budget_status"] for r in gold} == {"OVER_BUDGET", "WARNING", "ON_TRACK"}


def test_confluence_run_merges_events_into_sessions(spark):
    from tidewater.plans.catalog import QUERIES
    s = QUERIES["confluence_medallion_sessions"](spark, "/root/testdata/sf0.01")
    assert s.filter("events_in_session > 2").count() > 100
