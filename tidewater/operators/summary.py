"""Gold: per-team measures, dimension join, budget metrics and report views.

Plan shape (the flagship): aggregate first, join second. Every measure is kept
in a mergeable form (counts, sums, min, max), so events can be reduced per
*member* (user) before they are mapped to teams through a membership table;
only one row per member crosses the membership join, and the final roll-up
to teams has map-side partial aggregation. The team dimension is joined to
the few aggregated rows; whether a side is broadcast is Spark's choice, by the
sizes it knows or measures.

Money is summed as a decimal and rounded once, so a total doesn't depend on
the order in which partitions are added up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.columns import band, guarded_pct
from tidewater.schemas import (BUDGET_STATUS_THRESHOLDS, COST_TIER_THRESHOLDS,
                               GOLD_COLUMNS, GOLD_PREVIEW_COLUMNS)

COST_TIERS = ("HIGH", "MEDIUM", "LOW")
BUDGET_STATUSES = ("OVER_BUDGET", "WARNING", "ON_TRACK")
TEAM_KEYS = ("team_id", "team_name")
DIM_COLUMNS = ("department", "plan_tier", "monthly_budget", "region")

# exact sums of unit costs, at most six decimals each
MONEY = "decimal(24,6)"


def unique_members(members: DataFrame, member_key: str, keys: Sequence[str]) -> DataFrame:
    """One row per member: of several memberships the one with the smallest keys.

    Events of a member then count once, whatever the membership table holds."""
    picked = members.groupBy(member_key).agg(F.min(F.struct(*keys)).alias("_m"))
    return picked.select(member_key, *[F.col(f"_m.{k}").alias(k) for k in keys])


def _partials(events: DataFrame, keys: Sequence[str], is_ai: Column, cost: Column,
              rt: Column, ts: Column) -> DataFrame:
    return events.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(is_ai).alias("_ai"),
        F.sum(cost.cast(MONEY)).alias("_cost"),
        F.sum(rt).alias("_rt_sum"),
        F.count(rt).alias("_rt_n"),
        F.min(ts).alias("_t0"),
        F.max(ts).alias("_t1"),
    )


def _merge(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    return partials.groupBy(*keys).agg(
        F.sum("_n").alias("_n"), F.sum("_ai").alias("_ai"), F.sum("_cost").alias("_cost"),
        F.sum("_rt_sum").alias("_rt_sum"), F.sum("_rt_n").alias("_rt_n"),
        F.min("_t0").alias("_t0"), F.max("_t1").alias("_t1"))


def _finish(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    return partials.select(
        *keys,
        F.col("_n").cast("long").alias("total_events"),
        F.col("_ai").cast("long").alias("ai_api_calls"),
        F.round("_cost", 4).cast("double").alias("total_cost_usd"),
        F.round(F.col("_rt_sum") / F.col("_rt_n"), 1).alias("avg_response_time_ms"),
        F.col("_t0").alias("period_start"),
        F.col("_t1").alias("period_end"),
    )


def team_measures(events: DataFrame, keys: Sequence[str] = TEAM_KEYS,
                  is_ai: Column | None = None, cost: str = "cost_estimate_usd",
                  response_time: str = "response_time_ms", ts: str = "event_ts",
                  members: DataFrame | None = None, member_key: str | None = None,
                  extra_keys: Sequence[Column] = (), per_member: bool = True) -> DataFrame:
    """Grouped measures: total_events, ai_api_calls, total_cost_usd (4 dp),
    avg_response_time_ms (1 dp, NULLs skipped), period_start, period_end.

    Without ``members`` the events must carry ``keys``. With ``members`` (a
    frame holding ``member_key`` and ``keys``) the events carry ``member_key``
    instead; events of unknown members keep NULL keys, and a member counts once
    (:func:`unique_members`). ``per_member`` reduces events to members before the
    join, which pays where a member has many events per group; without it they
    are joined first and reduced once. ``extra_keys`` adds computed group keys
    (e.g. a month).
    """
    is_ai = is_ai if is_ai is not None else F.col("is_ai_event")
    cost_c, rt_c, ts_c = F.col(cost), F.col(response_time), F.col(ts)
    extra_names = []
    if extra_keys:
        events = events.select("*", *extra_keys)
        extra_names = [events.columns[-len(extra_keys) + i] for i in range(len(extra_keys))]
    if members is None:
        parts = _partials(events, [*keys, *extra_names], is_ai, cost_c, rt_c, ts_c)
        return _finish(parts, [*keys, *extra_names])
    if member_key is None:
        raise ValueError("member_key is required with members")
    teams_of = unique_members(members, member_key, keys)
    if not per_member:
        mapped = events.join(teams_of, member_key, "left")
        return _finish(_partials(mapped, [*keys, *extra_names], is_ai, cost_c, rt_c, ts_c), [*keys, *extra_names])
    reduced = _partials(events, [member_key, *extra_names], is_ai, cost_c, rt_c, ts_c)
    mapped = reduced.join(teams_of, member_key, "left")
    return _finish(_merge(mapped, [*keys, *extra_names]), [*keys, *extra_names])


PARTIALS = ("_n", "_ai", "_cost", "_rt_sum", "_rt_n", "_t0", "_t1")


def measure_partials(events: DataFrame, keys: Sequence[str], is_ai: Column | None = None,
                     cost: str = "cost_estimate_usd", response_time: str = "response_time_ms",
                     ts: str = "event_ts") -> DataFrame:
    """The measures of :func:`team_measures` in a form that merges exactly: counts, decimal and
    integer sums, min and max per ``keys`` (a day and a member, say). Keep these in a table, and a
    correction of a day replaces that day's rows only."""
    return _partials(events, keys, is_ai if is_ai is not None else F.col("is_ai_event"), F.col(cost),
                     F.col(response_time), F.col(ts))


def measures_of_partials(partials: DataFrame, members: DataFrame, member_key: str,
                         keys: Sequence[str] = TEAM_KEYS) -> DataFrame:
    """:func:`team_measures` from stored partials: merged per member, mapped to groups, merged again."""
    per_member = _merge(partials, [member_key])
    mapped = per_member.join(unique_members(members, member_key, keys), member_key, "left")
    return _finish(_merge(mapped, keys), keys)


def join_teams(measures: DataFrame, teams: DataFrame, key: str = "team_id",
               keep: str = "events", name_col: str = "team_name",
               dim_columns: Sequence[str] = DIM_COLUMNS) -> DataFrame:
    """Attach team metadata (budget cast to double).

    ``keep="events"``: every aggregated team, unknown ids with NULL metadata,
    quiet teams absent (what the original job computes). ``keep="teams"``:
    every dimension team, measures zero-filled for quiet teams (what its
    documentation promises).
    """
    dim = teams.select(key, *[F.col(c).cast("double").alias(c) if c == "monthly_budget"
                              else F.col(c) for c in dim_columns],
                       *([F.col(name_col).alias("_dim_name")] if keep == "teams" else []))
    if keep == "events":
        return measures.join(dim, key, "left")
    if keep != "teams":
        raise ValueError("keep must be 'events' or 'teams'")
    joined = dim.join(measures, key, "left")
    return (joined
            .withColumn(name_col, F.coalesce(F.col(name_col), F.col("_dim_name")))
            .withColumn("total_events", F.coalesce("total_events", F.lit(0)).cast("long"))
            .withColumn("ai_api_calls", F.coalesce("ai_api_calls", F.lit(0)).cast("long"))
            .withColumn("total_cost_usd", F.coalesce("total_cost_usd", F.lit(0.0)))
            .drop("_dim_name"))


def budget_metrics(df: DataFrame, cost_tiers: Sequence[float] = COST_TIER_THRESHOLDS,
                   status_levels: Sequence[float] = BUDGET_STATUS_THRESHOLDS,
                   stamp_col: str | None = "gold_created_at") -> DataFrame:
    """``budget_used_pct`` (rounded to 1 dp *before* banding), ``cost_tier``,
    ``budget_status`` and the creation stamp."""
    out = (df.withColumn("budget_used_pct", guarded_pct("total_cost_usd", "monthly_budget", 1))
           .withColumn("cost_tier", band("total_cost_usd", cost_tiers, COST_TIERS))
           .withColumn("budget_status", band("budget_used_pct", status_levels, BUDGET_STATUSES)))
    return out.withColumn(stamp_col, F.current_timestamp()) if stamp_col else out


def gold_contract(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The Gold columns in their fixed order (stamp included only if present)."""
    cols = [c for c in GOLD_COLUMNS if c in df.columns or c != "gold_created_at"]
    return df.select(*cols, *extra)


def team_cost_summary(events: DataFrame, teams: DataFrame, keep: str = "events",
                      members: DataFrame | None = None, member_key: str | None = None,
                      is_ai: Column | None = None, cost: str = "cost_estimate_usd",
                      response_time: str = "response_time_ms", ts: str = "event_ts",
                      cost_tiers: Sequence[float] = COST_TIER_THRESHOLDS,
                      status_levels: Sequence[float] = BUDGET_STATUS_THRESHOLDS,
                      stamp: bool = True) -> DataFrame:
    """The complete team cost summary: measures -> team join -> metrics -> contract."""
    m = team_measures(events, is_ai=is_ai, cost=cost, response_time=response_time, ts=ts,
                      members=members, member_key=member_key)
    j = join_teams(m, teams, keep=keep)
    g = budget_metrics(j, cost_tiers, status_levels, "gold_created_at" if stamp else None)
    return gold_contract(g)


def monthly_team_cost(events: DataFrame, teams: DataFrame, ts: str = "event_ts",
                      members: DataFrame | None = None, member_key: str | None = None,
                      is_ai: Column | None = None, cost: str = "cost_estimate_usd",
                      response_time: str = "response_time_ms",
                      cost_tiers: Sequence[float] = COST_TIER_THRESHOLDS,
                      status_levels: Sequence[float] = BUDGET_STATUS_THRESHOLDS,
                      stamp: bool = True) -> DataFrame:
    """One row per team and calendar month, with the change against the team's
    previous calendar month, NULL where that has no events (the window holds
    one row per month, so its size is bounded by the time span, not the data).
    A member has few events a month, so events are reduced once, after the
    membership join."""
    month = F.trunc(F.col(ts).cast("date"), "month").alias("month")
    m = team_measures(events, is_ai=is_ai, cost=cost, response_time=response_time, ts=ts,
                      members=members, member_key=member_key, extra_keys=[month], per_member=False)
    j = join_teams(m, teams, keep="events")
    g = budget_metrics(j, cost_tiers, status_levels, "gold_created_at" if stamp else None)
    w = Window.partitionBy("team_id", "team_name").orderBy("month")
    last = F.lag("month").over(w) == F.add_months("month", -1)
    g = (g.withColumn("prev_month_cost_usd", F.when(last, F.lag("total_cost_usd").over(w)))
         .withColumn("cost_change_usd",
                     F.round(F.col("total_cost_usd") - F.col("prev_month_cost_usd"), 4)))
    return gold_contract(g, extra=("month", "prev_month_cost_usd", "cost_change_usd"))


def top_spenders(gold: DataFrame, n: int = 20,
                 columns: Sequence[str] = GOLD_PREVIEW_COLUMNS) -> DataFrame:
    """Ordered preview: highest spend first, ties by team_id; top ``n`` rows
    (planned as ``TakeOrderedAndProject``: a per-partition top-n, no full sort)."""
    return (gold.orderBy(F.col("total_cost_usd").desc_nulls_last(), F.col("team_id").asc())
            .limit(n).select(*columns))


def panel_totals(gold: DataFrame) -> DataFrame:
    """Dashboard stat row: total spend, events, AI calls and team count."""
    return gold.agg(
        F.round(F.sum(F.col("total_cost_usd").cast(MONEY)), 4).cast("double").alias("total_cost_usd"),
        F.sum("total_events").cast("long").alias("total_events"),
        F.sum("ai_api_calls").cast("long").alias("ai_api_calls"),
        F.count(F.lit(1)).alias("teams"),
        F.count_if(F.col("budget_status") == "OVER_BUDGET").alias("teams_over_budget"),
    )


def panel_spend_by_team(gold: DataFrame) -> DataFrame:
    """Dashboard bar chart: spend and budget share per team."""
    return gold.select("team_id", "team_name", "total_cost_usd", "monthly_budget",
                       "budget_used_pct", "budget_status")
