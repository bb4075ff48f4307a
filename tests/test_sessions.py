import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE, rows
from tidewater.operators.sessions import interval_micros, sessionize

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def _df(spark, data):
    return spark.createDataFrame(data, "user_id string, event_ts timestamp_ntz")


def _sessions(df, split):
    return sorted(rows(sessionize(df, ["user_id"], split=split)))


@pytest.mark.parametrize("split", [None, "1 hour", "45 minutes", "1 day"])
def test_gap_boundary_inclusive(spark, split):
    m = dt.timedelta(minutes=1)
    s = dt.timedelta(seconds=1)
    data = [("a", T0), ("a", T0 + 29 * m + 59 * s),            # 29:59 -> same
            ("b", T0), ("b", T0 + 30 * m),                    # 30:00 -> same
            ("c", T0), ("c", T0 + 30 * m + s),                # 30:01 -> split
            ("d", T0),                                        # single event: duration 0
            ("e", None)]                                      # NULL time: no session
    out = _sessions(_df(spark, data), split)
    by_user = {}
    for u, start, end, n, d in out:
        by_user.setdefault(u, []).append((n, d))
    assert by_user["a"] == [(2, 29.983333333333334)]
    assert by_user["b"] == [(2, 30.0)]
    assert by_user["c"] == [(1, 0.0), (1, 0.0)]
    assert by_user["d"] == [(1, 0.0)]
    assert "e" not in by_user


def test_subsecond_truncated(spark):
    data = [("a", T0.replace(microsecond=900000)), ("a", T0 + dt.timedelta(seconds=1, microseconds=100000))]
    (_, start, end, n, d), = _sessions(_df(spark, data), "1 hour")
    assert n == 2 and d == pytest.approx(1 / 60)


@pytest.mark.parametrize("split", ["1 hour", "31 minutes", "2 hours", "1 day"])
def test_two_level_equals_single_level_on_events(spark, split):
    ev = spark.read.parquet(f"{SF_ORACLE}/events.parquet")
    ref = sessionize(ev, ["user_id"], ts="ts", split=None)
    got = sessionize(ev, ["user_id"], ts="ts", split=split)
    assert ref.exceptAll(got).count() == 0 and got.exceptAll(ref).count() == 0


def test_hot_key_chain_across_many_buckets(spark):
    # one key, an event every 20 minutes for two days: one session crossing 48 buckets
    data = [("hot", T0 + dt.timedelta(minutes=20 * i)) for i in range(144)]
    data += [("hot", T0 + dt.timedelta(days=3))]
    out = _sessions(_df(spark, data), "1 hour")
    assert [(r[3]) for r in out] == [144, 1]


def test_properties(spark):
    ev = spark.read.parquet(f"{SF_ORACLE}/events.parquet")
    s = sessionize(ev, ["user_id"], ts="ts")
    assert s.agg(F.sum("events_in_session")).first()[0] == ev.count()
    # sessions of one key are more than the gap apart
    from pyspark.sql import Window
    w = Window.partitionBy("user_id").orderBy("session_start")
    gaps = s.withColumn("g", F.col("session_start").cast("timestamp").cast("double")
                        - F.lag(F.col("session_end").cast("timestamp").cast("double")).over(w))
    assert gaps.filter(F.col("g") <= 1800).count() == 0


def test_interval_parser():
    assert interval_micros("30 minutes") == 1_800_000_000
    assert interval_micros("1 hour 30 minutes") == 5_400_000_000
    with pytest.raises(ValueError):
        interval_micros("3 fortnights")


def test_before_1970_and_across_epoch(spark):
    e0 = dt.datetime(1970, 1, 1)
    data = [("a", e0 - dt.timedelta(minutes=50)), ("a", e0 - dt.timedelta(minutes=25)),
            ("a", e0 + dt.timedelta(minutes=4)), ("a", e0 + dt.timedelta(hours=3)),
            ("b", dt.datetime(1969, 6, 1, 12, 0)), ("b", dt.datetime(1969, 6, 1, 12, 59, 59))]
    assert _sessions(_df(spark, data), "1 hour") == _sessions(_df(spark, data), None)


def test_wall_clock_times_across_a_daylight_saving_change(spark):
    # 01:00-02:00 happens twice in Los Angeles on 2024-11-03; TIMESTAMP_NTZ
    # values are wall-clock times and must not be shifted by the session zone
    ts = [dt.datetime(2024, 11, 3, 0, 50), dt.datetime(2024, 11, 3, 1, 10),
          dt.datetime(2024, 11, 3, 1, 40), dt.datetime(2024, 11, 3, 2, 5)]
    df = _df(spark, [("u", t) for t in ts])
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        for split in (None, "1 hour", "20 minutes"):
            assert _sessions(df, split) == [("u", ts[0], ts[-1], 4, 75.0)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
