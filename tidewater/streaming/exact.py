"""Streams that write versioned tables batch by batch: each batch once, all its tables together.

A micro-batch is read once and staged; what follows from it (Silver,
quarantine, an audit row; or sessions) is one :class:`~tidewater.sinks.lake.Change`,
committed with the batch's number. A batch that Spark replays after a failure
finds its number committed and changes nothing; one that failed before its
commit left nothing that readers see. The number is kept per query id, which
the checkpoint holds, so a new checkpoint starts a new count.

No watermark drops rows here. Silver's duplicates are found by a join with
Silver itself (:func:`tidewater.sinks.upsert.upsert`) and not in state, so rows
may arrive in any order and at any distance, and stamps may run backwards.
Sessions are merged with the stored ones that they touch, so late rows join
theirs and open ones are there as far as they are known.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.functions.rules import RuleSet
from tidewater.operators.dedup import latest_per_key
from tidewater.operators.enrich import enrich_cost
from tidewater.operators.sessions import interval_micros, merge_sessions, sessionize
from tidewater.operators.validate import REASON, with_reason
from tidewater.schemas import AI_COST_PER_CALL_USD, SESSION_GAP
from tidewater.session import remove_path, scratch_path
from tidewater.sinks.lake import Change, Lake, Partition, _Files
from tidewater.sinks.upsert import NEW, WINS, key_bucket, upsert

Work = Callable[[Change, DataFrame, int], None]
Hook = Callable[[int], None]


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    return json.loads(_Files(spark, checkpoint).text(f"{checkpoint}/metadata"))["id"]


def run_batch(lake: Lake, stream: str, batch: DataFrame, batch_id: int, work: Work,
              before_commit: Hook | None = None) -> bool:
    """Do one batch's ``work`` and commit it under its number; False where that was done before."""
    change = lake.change()
    if batch_id <= change.mark(f"{stream}.batch", -1):
        return False
    spark = batch.sparkSession
    staged = scratch_path(spark, "batch")
    batch.write.parquet(staged)   # the only read of the source
    work(change, spark.read.schema(batch.schema).parquet(staged), batch_id)
    change.set_mark(f"{stream}.batch", batch_id)
    if before_commit:
        before_commit(batch_id)
    change.commit()
    remove_path(spark, staged)
    return True


def start_exact(stream: DataFrame, lake: Lake, checkpoint: str, work: Work, trigger: dict | None = None,
                query_name: str | None = None, before_commit: Hook | None = None,
                after_commit: Hook | None = None) -> StreamingQuery:
    """Start a query that does ``work`` for every micro-batch, exactly once.

    The hooks are for what must happen around a commit (metrics, and faults in tests)."""
    spark = stream.sparkSession
    ids: dict[str, str] = {}

    def each(batch: DataFrame, batch_id: int) -> None:
        name = ids.setdefault("id", _query_id(spark, checkpoint))
        run_batch(lake, f"stream.{name}", batch, batch_id, work, before_commit)
        if after_commit:
            after_commit(batch_id)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def silver_work(rules: RuleSet, key: str = "event_id", ts: str = "event_ts", arrival: str = "ingested_at",
                is_ai: Column | None = None, rate: float | Column = AI_COST_PER_CALL_USD,
                buckets: int = 16, by_day: bool = False) -> Work:
    """Tables ``silver``, ``quarantine`` and ``audit`` from typed Bronze rows.

    Silver holds the copy of a key with the latest ``arrival`` (then the largest
    hash of the row), as the batch form does, partitioned by a hash of the key.
    With ``by_day`` it is partitioned by the event's day too, so that a batch
    meets only the days it has: choose it where copies of an event carry its
    event time. The audit row of a batch holds counts for which rows in =
    quarantined + new in Silver + duplicates.
    """
    partition_by = (["event_date"] if by_day else []) + ["key_bucket"]

    def work(change: Change, rows: DataFrame, batch_id: int) -> None:
        judged = with_reason(rows, rules).withColumn("_valid", rules.valid())
        valid = judged.filter("_valid").drop("_valid", REASON)
        bad = judged.filter(F.col(REASON).isNotNull()).drop("_valid")
        change.append("quarantine", bad)
        quarantined = F.count_if(F.col(REASON).isNotNull()).alias("quarantined")
        n, n_bad, n_valid = judged.agg(F.count(F.lit(1)), quarantined, F.count_if("_valid")).first()

        valid = valid.withColumns({"row_hash": F.xxhash64(*valid.columns), "key_bucket": key_bucket([key], buckets),
                                   **({"event_date": F.to_date(ts)} if by_day else {})})
        identity = [key, *(["event_date"] if by_day else [])]
        latest = latest_per_key(valid, identity, [F.col(arrival).desc(), F.col("row_hash").desc()])
        counts = upsert(change, "silver", enrich_cost(latest, is_ai=is_ai, rate=rate, stamp_col=None),
                        [key], [arrival, "row_hash"], partition_by)
        audit = (batch_id, n, n_bad, n_valid, counts[NEW], counts[WINS], n_valid - counts[NEW])
        change.append("audit", rows.sparkSession.createDataFrame(
            [audit], "batch_id long, rows_in long, rows_quarantined long, rows_valid long, rows_new long, "
                     "rows_replaced long, duplicates_removed long"))

    return work


def update_sessions(change: Change, table: str, events: DataFrame, keys: Sequence[str], ts: str = "event_ts",
                    gap: str = SESSION_GAP) -> None:
    """Merge the sessions of new ``events`` into a stored table of sessions.

    The table is partitioned by the days on which its sessions start and end, so
    only partitions that reach within ``gap`` of a new event are read and
    written again; a key's older and later sessions stay where they are.
    """
    spark = events.sparkSession
    path = scratch_path(spark, "sessions")
    sessionize(events, keys, ts=ts, gap=gap).write.parquet(path)
    fresh = spark.read.parquet(path)
    reach = F.make_dt_interval(secs=F.lit(interval_micros(gap) / 1_000_000))
    day = lambda c: F.to_date(c).cast("string")
    spans = [tuple(r) for r in fresh.select(day(F.col("session_start") - reach), day(F.col("session_end") + reach))
             .distinct().collect()]   # days that have new events, not rows

    def near(p: Partition) -> bool:
        return any(p["start_date"] <= last and first <= p["end_date"] for first, last in spans)

    both = fresh
    if change.has(table):
        both = fresh.unionByName(change.read(table, near).drop("start_date", "end_date"))
    merged = (merge_sessions(both, keys, gap)
              .withColumns({"start_date": F.to_date("session_start"), "end_date": F.to_date("session_end")}))
    change.replace_partitions(table, merged, near, partition_by=["start_date", "end_date"])
    remove_path(spark, path)


def sessions_work(table: str, keys: Sequence[str], ts: str = "event_ts", gap: str = SESSION_GAP) -> Work:
    """Table ``table`` of sessions, as in the batch form, from a stream of events."""
    def work(change: Change, rows: DataFrame, batch_id: int) -> None:
        update_sessions(change, table, rows, keys, ts, gap)

    return work


__all__ = ["run_batch", "sessions_work", "silver_work", "start_exact", "update_sessions"]
