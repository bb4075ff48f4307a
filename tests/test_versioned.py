"""Versioned tables, keyed merges, exact streams, gated publishing and supervision."""

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from tidewater.functions.rules import JIRA_RULES
from tidewater.operators.dedup import latest_per_key
from tidewater.operators.expectations import QualityGateError, expect_not_null, run_suite
from tidewater.operators.sessions import merge_sessions, sessionize
from tidewater.operators.uniqueness import index_counts, index_ids
from tidewater.operators.validate import split_valid
from tidewater.plans.catalog import clean_suite, q_team_cost_summary, timed_events
from tidewater.plans.increments import Planned, once, q_gate_blocks
from tidewater.plans.medallion import publish_gated
from tidewater.sinks import Lake, merge_changes, overwrite_table, upsert
from tidewater.sinks.lake import CommitConflict
from tidewater.sinks.upsert import key_bucket
from tidewater.sources.lake import read_table
from tidewater.sources.stream import read_file_stream
from tidewater.streaming import (RowsDropped, run_supervised, silver_work, start_append, start_exact,
                                 update_sessions)


def values(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


# -- versions ---------------------------------------------------------------

def test_failed_overwrite_leaves_the_former_table(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(spark.range(10), path)
    bad = spark.range(100, 200, 1, 4).select(F.when(F.col("id") == 199, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        overwrite_table(bad, path)
    assert values(read_table(spark, path), "id") == [(i,) for i in range(10)]
    overwrite_table(read_table(spark, path).filter("id > 6"), path)   # also from itself
    assert values(read_table(spark, path), "id") == [(7,), (8,), (9,)]


def test_tables_and_marks_change_together(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    assert not Lake.at(spark, lake.root) and lake.tables() == [] and lake.mark("m") is None
    change = lake.change()
    change.replace("a", spark.range(3))
    change.append("b", spark.range(2))
    change.set_mark("m", 7)
    assert change.read("a").count() == 3 and lake.tables() == []
    assert change.commit() == 1
    assert lake.tables() == ["a", "b"] and lake.mark("m") == 7 and Lake.at(spark, lake.root)


def test_second_writer_of_a_version_is_refused(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    one, two = lake.change(), lake.change()
    one.append("t", spark.range(3))
    two.append("t", spark.range(5))
    one.commit()
    with pytest.raises(CommitConflict):
        two.commit()
    assert lake.read("t").count() == 3


def test_old_versions_go_and_shared_folders_stay(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), keep=2)
    lake.append("t", spark.range(1))
    for k in range(4):
        lake.append("t", spark.range(k))
        lake.replace("u", spark.range(k))
    assert lake.read("t").count() == 1 + 0 + 1 + 2 + 3 and lake.read("u").count() == 3
    assert len(os.listdir(f"{lake.root}/data/u")) == 2
    assert len([n for n in os.listdir(f"{lake.root}/_versions") if n.endswith(".json")]) == 2


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    rows = spark.createDataFrame([(1, "a/b"), (2, None), (3, "x y=1"), (4, "é")], "id int, p string")
    lake.append("t", rows, partition_by=["p"])
    change = lake.change()
    change.replace_partitions("t", spark.createDataFrame([(9, None)], "id int, p string"), lambda p: p["p"] in (None, "x y=1"),
                              partition_by=["p"])
    change.commit()
    assert values(lake.read("t"), "id", "p") == [(1, "a/b"), (4, "é"), (9, None)]
    assert values(lake.read("t", lambda p: p["p"] == "a/b"), "id") == [(1,)]
    assert lake.read("t", lambda p: False).columns == ["id", "p"]
    with pytest.raises(ValueError):
        lake.append("t", rows)


def test_schema_evolves(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.append("t", spark.createDataFrame([(1, 0.5, "x")], "a int, b float, c string"))
    lake.append("t", spark.createDataFrame([(1 << 40, 0.1, 5)], "a long, b double, d int"))
    assert values(lake.read("t"), "a", "b", "c", "d") == [(1, 0.5, "x", None), (1 << 40, 0.1, None, 5)]
    change = lake.change()
    change.rename_column("t", "c", "label")
    change.add_column("t", "c", LongType(), 3)          # a new column by an old name
    change.add_column("t", "e", StringType(), "old")
    change.append("t", spark.createDataFrame([(2, "y", 8)], "a int, label string, c long"))
    change.commit()
    assert lake.read("t").columns == ["a", "b", "label", "d", "c", "e"]
    assert values(lake.read("t"), "a", "label", "c", "e") == [
        (1, "x", 3, "old"), (1 << 40, None, 3, "old"), (2, "y", 8, None)]
    for bad in ("a string", "a double"):
        with pytest.raises(ValueError):
            lake.append("t", spark.createDataFrame([], bad))
    with pytest.raises(ValueError):
        lake.change().rename_column("t", "a", "b")


# -- merges -----------------------------------------------------------------

@pytest.mark.parametrize("seed", [1, 2])
def test_merges_in_any_order_keep_the_latest_row(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *range(12)]), rng.choice("abc"), rng.choice([None, 1, 2, 9, 10])) for _ in range(80)]
    schema = "k int, v string, at int"
    lake = Lake(spark, str(tmp_path / "lake"))
    for a in range(0, 80, 20):
        for _ in range(2):   # every increment comes twice
            change = lake.change()
            counts = merge_changes(change, "t", spark.createDataFrame(rows[a:a + 20], schema), ["k"], "at", buckets=3)
            change.commit()
        assert counts["new"] == counts["wins"] == 0
    hashed = spark.createDataFrame(rows, schema).withColumn("h", F.xxhash64("k", "v", "at"))
    want = latest_per_key(hashed, ["k"], [F.col("at").desc(), F.col("h").desc()])
    assert values(lake.read("t"), "k", "v", "at") == values(want, "k", "v", "at")
    assert lake.mark("t.mark") == "10"


def test_merge_writes_only_partitions_with_a_replaced_row(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    rows = spark.range(100).select("id", F.lit(1).alias("at"), key_bucket(["id"], 8).alias("b"))
    for new in (rows, rows.filter("b = 3").withColumn("at", F.lit(2))):
        before = set(lake.state()["tables"].get("t", {"folders": []})["folders"])
        change = lake.change()
        upsert(change, "t", new, ["id"], ["at"], ["b"])
        change.commit()
    after = lake.state()["tables"]["t"]["folders"]
    assert len(before) == 8 and len(before & set(after)) == 7 and len(after) == 8
    assert lake.read("t").groupBy("at").count().filter("at = 2").first()["count"] == rows.filter("b = 3").count()


# -- streams ----------------------------------------------------------------

TYPED = ("event_id string, event_type string, event_ts timestamp_ntz, team_id string, user_id string, "
         "user_email string, ingested_at timestamp")


def feed(seed, n=60):
    rng = random.Random(seed)
    import datetime as dt

    day = dt.datetime(2024, 1, 1)
    out = []
    for _ in range(n):
        i = rng.randint(0, 25)
        out.append((str(i), rng.choice(["view", "click"]),
                    None if rng.random() < 0.1 else day + dt.timedelta(hours=rng.randint(0, 60)), "t1", "u1", "u@x.org",
                    dt.datetime(2024, 5, 1) + dt.timedelta(minutes=rng.randint(0, 200))))
    return out


def test_silver_equals_batch_for_any_arrival_order_and_replays(spark, tmp_path):
    rows = feed(5)
    lake, landed = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "landed")
    before, after = once(1), once(2)
    for a in range(0, 60, 15):
        spark.createDataFrame(rows[a:a + 15], TYPED).coalesce(1).write.mode("append").parquet(landed)
        for _ in range(2):
            q = start_exact(read_file_stream(spark, landed, TYPED), lake, str(tmp_path / "cp"), silver_work(JIRA_RULES, buckets=4),
                            before_commit=before, after_commit=after)
            try:
                q.awaitTermination()
            except Exception as e:
                assert Planned.__name__ in str(e)
    typed = spark.createDataFrame(rows, TYPED)
    valid, bad = split_valid(typed, JIRA_RULES)
    hashed = valid.withColumn("h", F.xxhash64(*valid.columns))
    want = latest_per_key(hashed, ["event_id"], [F.col("ingested_at").desc(), F.col("h").desc()])   # ids on several days
    assert values(lake.read("silver"), *typed.columns) == values(want, *typed.columns)
    assert values(lake.read("quarantine"), *typed.columns) == values(bad, *typed.columns)
    a = lake.read("audit").agg(*[F.sum(c).alias(c) for c in ("rows_in", "rows_quarantined", "rows_new", "duplicates_removed")]).first()
    assert a["rows_in"] == 60 == a["rows_quarantined"] + a["rows_new"] + a["duplicates_removed"]
    assert a["rows_new"] == lake.read("silver").count() and lake.read("audit").count() == 4


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sessions_in_increments_equal_one_run(spark, tmp_path, seed):
    rng = random.Random(seed)
    lake = Lake(spark, str(tmp_path / "lake"))
    import datetime as dt

    rows = [(rng.choice([None, "a", "b"]), dt.datetime(2024, 1, 1, 20) + dt.timedelta(minutes=rng.choice([10, 15, 30, 31]) * rng.randint(0, 150)))
            for _ in range(150)] + [("a", None)]
    events = spark.createDataFrame([(u, t, rng.randint(0, 3)) for u, t in rows], "u string, ts timestamp_ntz, part int")
    for part in range(4):
        change = lake.change()
        update_sessions(change, "s", events.filter(F.col("part") == part), ["u"], ts="ts")
        change.commit()
    change = lake.change()
    update_sessions(change, "s", events.limit(0), ["u"], ts="ts")
    change.commit()
    want = sessionize(events, ["u"], ts="ts")
    assert values(lake.read("s"), *want.columns) == values(want, *want.columns)
    assert values(merge_sessions(want, ["u"]), *want.columns) == values(want, *want.columns)


def test_older_sessions_keep_their_folders(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    events = spark.range(40).select(F.lit("u").alias("u"), F.make_timestamp_ntz(F.lit(2024), F.lit(1), (F.col("id") % 10 + 1).cast("int"),
                                                                               (F.col("id") % 7 + 8).cast("int"), F.lit(0), F.lit(0.0)).alias("ts"))
    change = lake.change()
    update_sessions(change, "s", events, ["u"], ts="ts")
    change.commit()
    before = set(lake.state()["tables"]["s"]["folders"])
    change = lake.change()
    update_sessions(change, "s", events.filter(F.dayofmonth("ts") == 4), ["u"], ts="ts")
    change.commit()
    gone = before - set(lake.state()["tables"]["s"]["folders"])
    assert len(before) == 10 and len(gone) == 1 and "start_date=2024-01-04" in gone.pop()


def test_gate_publishes_all_or_only_the_report(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    suite = [expect_not_null("v")]
    gold = lambda s: s.agg(F.sum("v").alias("v"))
    publish_gated(spark, lake, spark.createDataFrame([(1,), (2,)], "v int"), gold, suite)
    with pytest.raises(QualityGateError):
        publish_gated(spark, lake, spark.createDataFrame([(1,), (None,)], "v int"), gold, suite)
    assert values(lake.read("gold"), "v") == [(3,)] and values(lake.read("silver"), "v") == [(1,), (2,)]
    assert lake.read("quality_reports").count() == 2


def test_gate_blocks_keeps_gold_of_events_with_a_free_call(spark, tmp_path):
    """One purchase costs nothing, so the first run's report has a failed check; its Gold stays."""
    events = [(i, datetime.datetime(2024, 1, 1 + i % 9, i % 24), i % 4, ("purchase", "view")[i % 2], 0.0 if i == 2 else 1.5 + i, f'{{"k": {i}}}')
              for i in range(60)]
    tables = {
        "events": (events, "event_id long, ts timestamp, user_id long, event_type string, value double, props string"),
        "customer": ([(i, f"c{i}", i % 2, "BUILDING", 1.0) for i in range(4)],
                     "c_custkey long, c_name string, c_nationkey int, c_mktsegment string, c_acctbal double"),
        "nation": ([(0, "ALGERIA", 0), (1, "BRAZIL", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "AFRICA")], "r_regionkey int, r_name string")}
    for name, (data, kind) in tables.items():
        spark.createDataFrame(data, kind).write.parquet(str(tmp_path / f"{name}.parquet"))
    failed = run_suite(timed_events(spark, str(tmp_path)), clean_suite()).where("check = 'ai_cost_consistency'").first()
    assert failed["status"] == "FAILED"
    columns = ("team_id", "total_events", "ai_api_calls", "total_cost_usd")
    got = values(q_gate_blocks(spark, str(tmp_path)), *columns)
    assert got == values(q_team_cost_summary(spark, str(tmp_path)), *columns)
    assert sum(r[1] for r in got) == 60 and sum(r[2] for r in got) == 30


def test_id_index_reads_no_older_rows(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("a", 2), (None, 2), (None, 3), ("c", 3), ("c", 3)], "id string, day int")
    for days in ([1], [2, 3], [3]):
        change = lake.change()
        index_ids(change, "ids", rows.filter(F.col("day").isin(days)), "id", "day")
        change.commit()
    r = index_counts(lake.read("ids"), "day").first()
    assert tuple(r) == (8, 4, 4, 2)
    assert len({f.split("/")[1] for f in lake.state()["tables"]["ids"]["folders"]}) == 3


# -- supervision ------------------------------------------------------------

def test_supervisor_restarts_and_gives_up(spark, tmp_path):
    landed = str(tmp_path / "landed")
    spark.range(40).repartition(4).write.parquet(landed)
    lake, progress, fault = Lake(spark, str(tmp_path / "lake")), Lake(spark, str(tmp_path / "progress")), once(2)

    def start(hook, cp):
        return lambda: start_exact(read_file_stream(spark, landed, "id long", max_files_per_trigger=1), lake, str(tmp_path / cp),
                                   lambda change, batch, _: change.append(cp, batch), before_commit=hook)

    assert run_supervised(spark, start(fault, "one"), progress, back_off_s=0.01) == 1
    assert sorted(values(lake.read("one"), "id")) == [(i,) for i in range(40)]
    p = progress.read("progress")
    assert p.filter("failure is not null").count() == 1 and p.agg(F.sum("rows_in")).first()[0] >= 40

    def always(_):
        raise Planned(Planned.__name__)

    with pytest.raises(Exception, match="Planned"):
        run_supervised(spark, start(always, "two"), progress, max_restarts=1, back_off_s=0.01)
    assert "two" not in lake.tables()


def test_supervisor_fails_a_run_that_drops_rows(spark, tmp_path):
    landed = str(tmp_path / "landed")
    for k, minute in enumerate((0, 300, 5)):
        (spark.createDataFrame([(k, minute)], "k int, minute int")
         .select("k", F.timestamp_seconds(F.col("minute") * 60).alias("ts")).coalesce(1).write.mode("append").parquet(landed))

    def start():
        s = read_file_stream(spark, landed, "k int, ts timestamp", max_files_per_trigger=1)
        return start_append(s.withWatermark("ts", "1 minute").dropDuplicatesWithinWatermark(["k"]), str(tmp_path / "out"),
                            str(tmp_path / "cp"), trigger={"availableNow": True})

    with pytest.raises(RowsDropped):
        run_supervised(spark, start, Lake(spark, str(tmp_path / "progress")))
