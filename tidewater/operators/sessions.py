"""Activity sessions: a session ends after ``gap`` of inactivity.

Two events of one key belong to the same session when they are at most
``gap`` apart (the boundary is inclusive). ``session_start`` / ``session_end``
are the first and last *event* times, not the window bounds; rows with a NULL
time form no session.

Skew. A plain ``groupBy(key, session_window(ts, gap))`` sends every event of
one key to one reducer, so a key holding a third of all rows becomes a third of
the job in a single task. Salting is not allowed to change sessions, so the
split is done on *time* instead and repaired exactly:

1. Level 1 sessionises per ``(key, time bucket)`` with ``session_window``
   (partial merge before the shuffle). A hot key is spread over as many tasks
   as it has buckets.
2. Only a session that starts within ``gap`` of its bucket's start or ends
   within ``gap`` of its end can merge with a neighbouring bucket. Sessions of
   one bucket are more than ``gap`` apart, so there are at most two such
   candidates per (key, bucket); every other session is final and leaves here.
3. Level 2 exchanges the candidates alone, chains those of a key by the gap
   rule (lag + running sum) and rolls the chains up. Both levels read the same
   first exchange. With buckets much wider than the gap the candidates are few.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.columns import duration_minutes
from tidewater.operators.summary import unique_members
from tidewater.schemas import SESSION_GAP

_UNITS_US = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000, "week": 7 * 86_400_000_000,
}


def interval_micros(text: str) -> int:
    """``"30 minutes"`` -> microseconds (plain "N unit" pairs, summed)."""
    parts = text.lower().split()
    if len(parts) % 2:
        raise ValueError(f"bad interval: {text!r}")
    total = 0
    for n, unit in zip(parts[::2], parts[1::2]):
        u = unit.rstrip("s")
        if u not in _UNITS_US:
            raise ValueError(f"bad interval unit in {text!r}")
        total += int(float(n) * _UNITS_US[u])
    return total


def _micros(col: str, ntz: bool):
    """Epoch microseconds. A TIMESTAMP_NTZ is wall-clock time: it is measured
    without the session time zone (a cast to TIMESTAMP would shift times across
    a daylight-saving change and break gaps there), as ``session_window`` does."""
    if ntz:
        epoch = F.make_timestamp_ntz(F.lit(1970), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
        return F.timestamp_diff("MICROSECOND", epoch, F.col(col))
    return F.unix_micros(F.col(col))


def sessionize(df: DataFrame, keys: Sequence[str], ts: str = "event_ts",
               gap: str = SESSION_GAP, split: str | None = "1 day",
               start_col: str = "session_start", end_col: str = "session_end",
               count_col: str = "events_in_session",
               duration_col: str = "session_duration_minutes") -> DataFrame:
    """Sessions per ``keys`` with ``session_start``, ``session_end``,
    ``events_in_session`` and ``session_duration_minutes``.

    ``split`` is the time-bucket width of the skew-safe two-level plan (see the
    module doc); ``None`` uses a single ``session_window`` aggregation.
    """
    keys = list(keys)
    events = df.select(*keys, ts).filter(F.col(ts).isNotNull())
    if split is None:
        out = (events.groupBy(*keys, F.session_window(ts, gap).alias("_sw"))
               .agg(F.min(ts).alias(start_col), F.max(ts).alias(end_col),
                    F.count(F.lit(1)).alias(count_col))
               .drop("_sw"))
        return out.withColumn(duration_col, duration_minutes(start_col, end_col))

    ntz = dict(events.dtypes)[ts] == "timestamp_ntz"
    g_us = interval_micros(gap)
    b_us = interval_micros(split)
    if b_us <= 0 or g_us < 0:
        raise ValueError("split must be positive and gap non-negative")

    local = (events
             .withColumn("_b", F.floor(_micros(ts, ntz) / F.lit(b_us)))
             .filter(F.col("_b").isNotNull())   # said here, else one branch alone infers it and reuse is lost
             .groupBy(*keys, "_b", F.session_window(ts, gap).alias("_sw"))
             .agg(F.min(ts).alias(start_col), F.max(ts).alias(end_col),
                  F.count(F.lit(1)).alias(count_col))
             .drop("_sw")
             .withColumn("_s", _micros(start_col, ntz))
             .withColumn("_e", _micros(end_col, ntz)))
    bucket_start = F.col("_b") * F.lit(b_us)
    edge = ((F.col("_s") < bucket_start + F.lit(g_us))
            | (F.col("_e") >= bucket_start + F.lit(b_us - g_us)))

    final = [*keys, start_col, end_col, count_col]
    w = Window.partitionBy(*keys).orderBy("_s", "_e")
    chained = (local.filter(edge)
               .withColumn("_new", F.when(F.col("_s") - F.lag("_e").over(w) <= F.lit(g_us), 0).otherwise(1))
               .withColumn("_sid", F.sum("_new").over(
                   w.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    rolled = (chained.groupBy(*keys, "_sid")
              .agg(F.min(start_col).alias(start_col), F.max(end_col).alias(end_col),
                   F.sum(count_col).alias(count_col)).select(*final))
    merged = local.filter(~edge).select(*final).union(rolled)
    return merged.withColumn(duration_col, duration_minutes(start_col, end_col))


def merge_sessions(sessions: DataFrame, keys: Sequence[str], gap: str = SESSION_GAP,
                   start_col: str = "session_start", end_col: str = "session_end",
                   count_col: str = "events_in_session",
                   duration_col: str = "session_duration_minutes") -> DataFrame:
    """Join the sessions of a key that overlap or lie within ``gap`` of one another.

    A session is (start, end, events), so sessions of parts of the events merge
    into those of all events, whatever the parts. A key's sessions meet in one
    task: they are sessions, not events, and at most one per gap of time.
    """
    keys = list(keys)
    ntz = dict(sessions.dtypes)[start_col] == "timestamp_ntz"
    w = Window.partitionBy(*keys).orderBy("_s", "_e")
    so_far = F.max("_e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return (sessions.select(*keys, start_col, end_col, count_col)
            .withColumns({"_s": _micros(start_col, ntz), "_e": _micros(end_col, ntz)})
            .withColumn("_new", F.when(F.col("_s") - so_far <= F.lit(interval_micros(gap)), 0).otherwise(1))
            .withColumn("_sid", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .groupBy(*keys, "_sid")
            .agg(F.min(start_col).alias(start_col), F.max(end_col).alias(end_col), F.sum(count_col).alias(count_col))
            .drop("_sid").withColumn(duration_col, duration_minutes(start_col, end_col)))


def average_session_by(sessions: DataFrame, members: DataFrame, member_key: str,
                       group_keys: Sequence[str], duration_col: str = "session_duration_minutes",
                       scale: int = 2) -> DataFrame:
    """Average session length per group (e.g. per team).

    Sessions are first reduced to one row per member (sum, count), so the join
    with ``members`` carries one row per member instead of one per session and a
    member with a huge session count cannot skew it; the average is rounded
    after averaging. Sessions of unknown members form a group of NULL keys, and
    a member of several groups counts in the smallest.
    """
    per_member = (sessions.groupBy(member_key)
                  .agg(F.sum(duration_col).alias("_d"), F.count(F.lit(1)).alias("_n")))
    return (per_member.join(unique_members(members, member_key, group_keys), member_key, "left")
            .groupBy(*group_keys)
            .agg(F.sum("_n").alias("sessions"),
                 F.round(F.sum("_d") / F.sum("_n"), scale).alias("avg_session_minutes")))
