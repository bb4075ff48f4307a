import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidewater.sinks import append_table, overwrite_table
from tidewater.sources.jdbc import conform_types, read_snapshot
from tidewater.sources.lake import read_table
from tidewater.streaming.ingest import await_all, start_append


def test_append_merges_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(spark.createDataFrame([(1, "a")], "id int, v string"), path)
    append_table(spark.createDataFrame([(2, "b", True)], "id int, v string, flag boolean"), path)
    out = read_table(spark, path, merge_schema=True).orderBy("id").collect()
    assert [tuple(r) for r in out] == [(1, "a", None), (2, "b", True)]


def test_conform_types_native_and_legacy(spark):
    df = spark.createDataFrame(
        [(1, D("12.50"), dt.datetime(2024, 1, 1, 8), True, None)],
        "id int, budget decimal(10,2), created_at timestamp, active boolean, note string")
    native = conform_types(df)
    assert dict(native.dtypes) == {"id": "int", "budget": "double", "created_at": "timestamp",
                                   "active": "boolean", "note": "string"}
    legacy = conform_types(df, legacy_text=True)
    assert dict(legacy.dtypes) == {"id": "double", "budget": "double", "created_at": "string",
                                   "active": "boolean", "note": "string"}
    r = legacy.first()
    assert r["note"] is None and r["created_at"].startswith("2024-01-01 08:00:00")


def test_a_snapshot_by_one_task_has_to_be_asked_for(spark):
    with pytest.raises(ValueError, match="single_task"):
        read_snapshot(spark, "jdbc:none://", "teams")
    with pytest.raises(ValueError, match="single_task"):
        read_snapshot(spark, "jdbc:none://", "teams", partition_column="team_id", lower_bound=0, upper_bound=9,
                      num_partitions=4, single_task=True)


def test_partitioned_snapshot_needs_all_bounds(spark):
    with pytest.raises(ValueError):
        read_snapshot(spark, "jdbc:none://", "teams", partition_column="team_id", num_partitions=4)


def test_await_all_raises_when_any_query_fails(spark, tmp_path):
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    src = lambda: spark.readStream.schema(schema).parquet(f"{SF_SMALL}/events*.parquet")
    ok = start_append(src(), str(tmp_path / "ok"), str(tmp_path / "cp_ok"),
                      trigger={"availableNow": True})
    # ANSI cast of text to int fails at run time inside the second query
    bad_stream = src().withColumn("boom", F.col("event_type").cast("int"))
    bad = start_append(bad_stream, str(tmp_path / "bad"), str(tmp_path / "cp_bad"),
                       trigger={"availableNow": True})
    with pytest.raises(RuntimeError):
        await_all([ok, bad], timeout_s=120)
    assert not ok.isActive and not bad.isActive


def test_await_all_stops_everything_when_time_runs_out(spark, tmp_path):
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    src = lambda: spark.readStream.schema(schema).parquet(f"{SF_SMALL}/events*.parquet")
    qs = [start_append(src(), str(tmp_path / n), str(tmp_path / f"cp_{n}")) for n in "ab"]   # never end
    with pytest.raises(TimeoutError):
        await_all(qs, timeout_s=2)
    assert not any(q.isActive for q in qs)


def test_shared_root_needs_a_setting_beyond_local_masters():
    from types import SimpleNamespace as N

    from tidewater.session import shared_root
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        unset = N(sparkContext=N(getCheckpointDir=lambda: None, master=master), conf=N(get=lambda k, d: d))
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_root(unset)


def test_remove_path(spark, tmp_path):
    from tidewater.session import remove_path
    spark.range(3).write.parquet(str(tmp_path / "t"))
    remove_path(spark, str(tmp_path / "t"))
    assert not (tmp_path / "t").exists()


def test_increment_appends_new_rows_and_moves_the_mark(spark, tmp_path):
    from tidewater.sources.jdbc import load_increment
    path = str(tmp_path / "t")
    rows_ = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "id int, v int")
    mark = load_increment(rows_.filter("v <= 20"), path, "v")
    assert mark == 20
    mark = load_increment(rows_, path, "v", mark)
    assert mark == 30 and load_increment(rows_, path, "v", mark) == 30
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 2, 3]
