"""Data-quality expectations evaluated in one aggregate pass.

Each expectation contributes aggregate *measures* (counts of violating rows and
the like), a pass condition over those measures and a details text. The suite
runs as a single ``agg`` over the table — one scan whatever the number of
checks — and the result rows are produced in Spark with ``inline``; nothing
but the one-row aggregate is ever needed on the driver, and only by the gate.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.schemas import (MIN_SILVER_ROWS, QUALITY_PIPELINE_NAME, QUALITY_TABLE_NAME,
                               RESPONSE_TIME_BOUNDS_MS)

TOTAL = "_total"


class QualityGateError(RuntimeError):
    """Raised when at least one expectation failed; blocks downstream steps."""


@dataclass(frozen=True)
class Expectation:
    """``measures`` maps local names to aggregate expressions. ``passed`` and
    ``details`` receive a resolver ``m(name)`` returning the aggregated column
    (``m("_total")`` is the row count)."""

    name: str
    description: str
    measures: dict[str, Column] = field(default_factory=dict)
    passed: Callable[[Callable[[str], Column]], Column] = lambda m: F.lit(True)
    details: Callable[[Callable[[str], Column]], Column] = lambda m: F.lit("")


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])


def expect_not_null(column: str, name: str | None = None,
                    description: str | None = None) -> Expectation:
    return Expectation(
        name or f"{column}_not_null",
        description or f"every row has a value in {column}",
        {"n": F.count_if(F.col(column).isNull())},
        lambda m: m("n") == 0,
        lambda m: _text(m("n"), f" null values in {column}"))


def expect_in_set(column: str, values: Sequence[str], name: str | None = None,
                  description: str | None = None) -> Expectation:
    """Rows outside ``values`` violate; NULL passes (``NOT IN`` of NULL is NULL)."""
    return Expectation(
        name or f"{column}_valid_values",
        description or f"{column} takes known values only: {', '.join(values)}",
        {"n": F.count_if(~F.col(column).isin(list(values)))},
        lambda m: m("n") == 0,
        lambda m: _text(m("n"), f" values of {column} that are not known"))


def expect_between(column: str, low: float, high: float, name: str | None = None,
                   description: str | None = None, unit: str = "") -> Expectation:
    """Inclusive bounds; NULL passes."""
    lo, hi = _num(low), _num(high)
    return Expectation(
        name or f"{column}_in_range",
        description or f"{column} lies in [{lo}, {hi}]",
        {"n": F.count_if((F.col(column) < low) | (F.col(column) > high))},
        lambda m: m("n") == 0,
        lambda m: _text(m("n"), f" values of {column} beyond [{lo}, {hi}]{unit}"))


def expect_not_negative(column: str, name: str | None = None,
                        description: str | None = None) -> Expectation:
    return Expectation(
        name or f"{column}_not_negative",
        description or f"{column} is never below zero",
        {"n": F.count_if(F.col(column) < 0)},
        lambda m: m("n") == 0,
        lambda m: _text(m("n"), f" values of {column} below zero"))


def expect_unique(column: str, name: str | None = None,
                  description: str | None = None) -> Expectation:
    """Distinct values (NULL counted as one value) must equal the row count."""
    return Expectation(
        name or f"no_duplicate_{column}s",
        description or f"each {column} occurs once",
        {"d": F.count_distinct(F.col(column)),
         "z": F.max(F.col(column).isNull().cast("int"))},
        lambda m: (m("d") + F.coalesce(m("z"), F.lit(0))) >= m(TOTAL),
        lambda m: _text(m(TOTAL) - m("d") - F.coalesce(m("z"), F.lit(0)),
                        f" repeated values of {column}"))


def expect_min_rows(minimum: int, name: str = "minimum_row_count",
                    description: str | None = None, table: str = "table") -> Expectation:
    return Expectation(
        name, description or f"{table} holds {minimum} rows or more", {},
        lambda m: m(TOTAL) >= minimum,
        lambda m: _text(m(TOTAL), f" rows; the minimum is {minimum}"))


def expect_flag_cost_consistent(flag: str, cost: str, name: str = "ai_cost_consistency",
                                description: str | None = None) -> Expectation:
    """Flagged rows must cost more than 0, unflagged rows exactly 0."""
    return Expectation(
        name,
        description or "a flagged event costs something and any other nothing",
        {"a": F.count_if((F.col(flag) == True) & (F.col(cost) == 0)),  # noqa: E712
         "b": F.count_if((F.col(flag) == False) & (F.col(cost) > 0))},  # noqa: E712
        lambda m: (m("a") == 0) & (m("b") == 0),
        lambda m: _text(m("a"), " flagged events without cost, ", m("b"), " other events with cost"))


def _num(x: float) -> str:
    return str(int(x)) if float(x).is_integer() else str(x)


def measure_suite(df: DataFrame, suite: Sequence[Expectation]) -> tuple[DataFrame, list]:
    """The single aggregate pass; returns (one-row frame, resolvers per check)."""
    aggs = [F.count(F.lit(1)).alias(TOTAL)]
    resolvers = []
    for i, e in enumerate(suite):
        for k, expr in e.measures.items():
            aggs.append(expr.alias(f"_m{i}_{k}"))

        def resolver(name: str, i=i) -> Column:
            return F.col(TOTAL) if name == TOTAL else F.col(f"_m{i}_{name}")
        resolvers.append(resolver)
    return df.agg(*aggs), resolvers


def run_suite(df: DataFrame, suite: Sequence[Expectation], stamp: bool = False) -> DataFrame:
    """One row per check: check, description, status (PASSED/FAILED), details
    [, timestamp]; plus ``rows_checked``."""
    row, res = measure_suite(df, suite)
    entries = []
    for e, m in zip(suite, res):
        ok = F.coalesce(e.passed(m), F.lit(False))
        entries.append(F.struct(
            F.lit(e.name).alias("check"),
            F.lit(e.description).alias("description"),
            F.when(ok, "PASSED").otherwise("FAILED").alias("status"),
            e.details(m).alias("details"),
            F.col(TOTAL).alias("rows_checked")))
    out = row.select(F.inline(F.array(*entries)))
    return out.withColumn("timestamp", F.current_timestamp()) if stamp else out


def quality_report(results: DataFrame, pipeline: str = QUALITY_PIPELINE_NAME,
                   table: str = QUALITY_TABLE_NAME, with_results: bool = True,
                   stamp: bool = True) -> DataFrame:
    """One row: pipeline, table, run_timestamp, total_rows_checked, checks_passed,
    checks_failed, quality_score_pct (1 dp) and the per-check results array.
    ``collect_list`` here gathers one struct per *check*, a fixed small number."""
    passed = F.count_if(F.col("status") == "PASSED")
    aggs = [F.lit(pipeline).alias("pipeline"), F.lit(table).alias("table"),
            F.max("rows_checked").alias("total_rows_checked"),
            passed.alias("checks_passed"),
            F.count_if(F.col("status") != "PASSED").alias("checks_failed"),
            F.round(passed / F.count(F.lit(1)) * 100, 1).alias("quality_score_pct")]
    if with_results:
        cols = [c for c in ("check", "description", "status", "details", "timestamp")
                if c in results.columns]
        aggs.append(F.collect_list(F.struct(*cols)).alias("results"))
    rep = results.agg(*aggs)
    if stamp:
        rep = rep.withColumn("run_timestamp", F.current_timestamp())
    return rep


def enforce(results: DataFrame) -> None:
    """The gate: raise :class:`QualityGateError` if any check failed.

    Brings back at most one row per failed check (bounded by the suite size)."""
    failed = [r["check"] for r in results.filter(F.col("status") != "PASSED")
              .select("check").collect()]
    if failed:
        raise QualityGateError(
            f"Data quality gate FAILED - {len(failed)} check(s) failed: {', '.join(failed)}")


# The names of the eight checks
CHECKS = ("event_id_not_null", "event_type_valid_values", "response_time_in_range", "cost_not_negative",
          "is_ai_event_not_null", "no_duplicate_event_ids", "minimum_row_count", "ai_cost_consistency")


def silver_suite(event_types: Sequence[str], min_rows: int = MIN_SILVER_ROWS,
                 response_time: str = "response_time_ms", bounds: tuple = RESPONSE_TIME_BOUNDS_MS,
                 cost: str = "cost_estimate_usd", flag: str = "is_ai_event",
                 event_type: str = "event_type", event_id: str = "event_id") -> list[Expectation]:
    """The eight checks of the Silver event table, parameterised by column names."""
    name = iter(CHECKS)
    return [
        expect_not_null(event_id, next(name)),
        expect_in_set(event_type, event_types, next(name)),
        expect_between(response_time, bounds[0], bounds[1], next(name), unit=" ms"),
        expect_not_negative(cost, next(name)),
        expect_not_null(flag, next(name)),
        expect_unique(event_id, next(name)),
        expect_min_rows(min_rows, next(name), table="Silver"),
        expect_flag_cost_consistent(flag, cost, next(name)),
    ]


def score_history(reports: DataFrame, grain: str = "day") -> DataFrame:
    """Quality score over time from appended reports: runs, average / minimum
    score and failed checks per ``grain`` (day, week, month) and table."""
    period = F.date_trunc(grain, F.col("run_timestamp").cast("timestamp")).alias("period")
    return (reports.groupBy("pipeline", "table", period)
            .agg(F.count(F.lit(1)).alias("runs"),
                 F.round(F.avg("quality_score_pct"), 1).alias("avg_score_pct"),
                 F.min("quality_score_pct").alias("min_score_pct"),
                 F.sum("checks_failed").alias("checks_failed")))
