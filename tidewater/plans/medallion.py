"""The medallion run as one plain function: Silver -> sessions -> quality gate -> Gold.

Each layer is written to storage and the next layer reads the written table,
which cuts lineage: a lost executor re-runs only tasks of the current job,
never the upstream layers. Audit counters are ``Observation``s attached to the
writing jobs, so counting costs no extra job. The quality gate runs between
Silver and Gold; a failed check raises and Gold is not written.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.rules import JIRA_RULES, RuleSet
from tidewater.operators.decode import parse_event_time, stamp, tag_source
from tidewater.operators.dedup import latest_per_key
from tidewater.operators.enrich import enrich_cost
from tidewater.operators.expectations import (Expectation, QualityGateError, enforce,
                                              quality_report, run_suite, silver_suite)
from tidewater.operators.sessions import sessionize
from tidewater.operators.summary import team_cost_summary
from tidewater.operators.validate import split_valid
from tidewater.schemas import (AI_COST_PER_CALL_USD, AI_EVENT_TYPE, JIRA_EVENT_TYPES,
                               REPORT)
from tidewater.session import remove_path, scratch_path
from tidewater.sinks import Lake, overwrite_table, write_report
from tidewater.sources.lake import read_table


@dataclass(frozen=True)
class Layout:
    """Table locations below one root (a shared, durable folder)."""

    root: str

    def _at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    quarantine = property(lambda self: self._at("quarantine"))
    silver = property(lambda self: self._at("silver"))
    sessions = property(lambda self: self._at("sessions"))
    audit = property(lambda self: self._at("audit"))
    quality_reports = property(lambda self: self._at("quality_reports"))
    gold = property(lambda self: self._at("gold"))


def stage_dimension(df: DataFrame, source: str, path: str, fmt: str = "parquet") -> None:
    """Snapshot a relational dimension into the lake with provenance tags."""
    overwrite_table(stamp(tag_source(df, source), "extracted_at"), path, fmt)


def run_silver(spark: SparkSession, bronze: DataFrame, out: Layout, rules: RuleSet = JIRA_RULES,
               key: str = "event_id", ts: str = "event_ts", is_ai: Column | None = None,
               rate: float | Column = AI_COST_PER_CALL_USD, *,
               tie_breakers: Sequence[Column],
               session_keys: Sequence[str] = ("user_id", "team_id", "team_name"),
               fmt: str = "parquet", ntz: bool = False,
               date_partition: str | None = None) -> dict:
    """Bronze -> quarantine + Silver + sessions + audit row; returns the audit counters.

    The latest copy of a key by ``ingested_at`` wins. One micro-batch shares one
    stamp, so ``tie_breakers`` decide next; a hash of the whole row closes the
    order, and only equal rows are left to chance.

    ``ntz`` types the event time as TIMESTAMP_NTZ instead of TIMESTAMP.
    ``date_partition`` names a column holding the event date by which Silver is
    partitioned on write, so readers filtering on dates prune whole directories.
    Rows with an unparsable time never reach Silver, so the date is never NULL."""
    typed = parse_event_time(bronze, ts, ntz=ntz)
    valid, bad = split_valid(typed, rules)

    q_obs = Observation("quarantine")
    overwrite_table(bad.observe(q_obs, F.count(F.lit(1)).alias("rows")), out.quarantine, fmt)

    v_obs, s_obs = Observation("valid"), Observation("silver")
    valid = valid.observe(v_obs, F.count(F.lit(1)).alias("rows"))
    latest = latest_per_key(valid, [key], [F.col("ingested_at").desc()],
                            [*tie_breakers, F.xxhash64(*valid.columns).desc()])
    silver = enrich_cost(latest, is_ai=is_ai if is_ai is not None
                         else F.col("event_type") == AI_EVENT_TYPE, rate=rate)
    parts: list[str] = []
    if date_partition:
        silver = silver.withColumn(date_partition, F.to_date(F.col(ts)))
        parts = [date_partition]
    overwrite_table(silver.observe(s_obs, F.count(F.lit(1)).alias("rows")), out.silver, fmt,
                    partition_by=parts)

    sess_obs = Observation("sessions")
    sessions = sessionize(read_table(spark, out.silver, fmt), list(session_keys), ts=ts)
    overwrite_table(sessions.observe(sess_obs, F.count(F.lit(1)).alias("rows")), out.sessions, fmt)

    quarantined, valid_n = q_obs.get["rows"], v_obs.get["rows"]
    silver_n = s_obs.get["rows"]
    audit = {"rows_in": quarantined + valid_n, "rows_quarantined": quarantined,
             "rows_valid": valid_n, "duplicates_removed": valid_n - silver_n,
             "rows_out": silver_n, "sessions": sess_obs.get["rows"]}
    overwrite_table(spark.createDataFrame([tuple(audit.values())],
                                          ", ".join(f"{k} long" for k in audit)), out.audit, fmt)
    return audit


def run_gate(spark: SparkSession, out: Layout, suite: Sequence[Expectation] | None = None,
             fmt: str = "parquet", enforce_gate: bool = True) -> DataFrame:
    """Expectations over the written Silver table; appends the report, then raises
    :class:`~tidewater.operators.expectations.QualityGateError` on any failure
    (``enforce_gate=False``: report only). Returns this run's result rows."""
    silver = read_table(spark, out.silver, fmt)
    results = run_suite(silver, suite or silver_suite(JIRA_EVENT_TYPES), stamp=True)
    run_id = uuid.uuid4().hex
    # one day of slack: the session's time zone dates the partition
    since = datetime.date.today() - datetime.timedelta(days=1)
    # one job scans Silver and writes the report; the gate then reads the
    # few written result rows back instead of scanning Silver a second time
    write_report(quality_report(results).withColumn("run_id", F.lit(run_id)),
                 out.quality_reports)
    reports = read_table(spark, out.quality_reports, "json", schema=REPORT)
    checks = (reports.filter((F.col("run_date") >= F.lit(since)) & (F.col("run_id") == run_id))
              .select(F.inline("results")))
    if enforce_gate:
        enforce(checks)
    return checks


def run_gold(spark: SparkSession, out: Layout, teams: DataFrame, keep: str = "events",
             fmt: str = "parquet", **summary_options) -> None:
    silver = read_table(spark, out.silver, fmt)
    overwrite_table(team_cost_summary(silver, teams, keep=keep, **summary_options), out.gold, fmt)


def run_medallion(spark: SparkSession, bronze: DataFrame, teams: DataFrame, root: str,
                  suite: Sequence[Expectation] | None = None, fmt: str = "parquet",
                  *, silver_options: dict, gold_options: dict | None = None,
                  enforce_gate: bool = True) -> dict:
    """Silver -> gate -> Gold. Returns the audit counters, the gate's result rows
    and the table locations. By default a failed check raises and Gold is not
    written; ``enforce_gate=False`` records the report and continues."""
    out = Layout(root)
    audit = run_silver(spark, bronze, out, fmt=fmt, **silver_options)
    checks = run_gate(spark, out, suite, fmt, enforce_gate)
    run_gold(spark, out, teams, fmt=fmt, **(gold_options or {}))
    return {"audit": audit, "gate": checks, "silver": out.silver, "quarantine": out.quarantine,
            "sessions": out.sessions, "audit_table": out.audit, "gold": out.gold, "reports": out.quality_reports}


def publish_gated(spark: SparkSession, lake: Lake, silver: DataFrame, summarize: Callable[[DataFrame], DataFrame],
                  suite: Sequence[Expectation], enforce_gate: bool = True) -> None:
    """Write, audit, publish: Silver is written beside the live version and checked there.

    Where all checks pass, Silver, Gold (``summarize`` of the written Silver) and
    the report become visible in one commit. Else only the report does, readers
    keep the former Silver and Gold, and the gate's error is raised
    (``enforce_gate=False``: all three are published, whatever the report says).
    """
    change = lake.change()
    change.replace("silver", silver)
    staged = change.read("silver")
    path = scratch_path(spark, "gate")
    quality_report(run_suite(staged, suite, stamp=True)).write.parquet(path)   # the one scan of Silver
    report = spark.read.parquet(path)
    if enforce_gate:
        try:
            enforce(report.select(F.inline("results")))
        except QualityGateError:
            lake.append("quality_reports", report)
            raise
    change.replace("gold", summarize(staged))
    change.append("quality_reports", report)
    change.commit()
    remove_path(spark, path)
