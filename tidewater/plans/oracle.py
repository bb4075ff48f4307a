"""Independent SQL (DuckDB dialect) for every catalogue query.

Written from the semantics, not from the Spark code: plain joins, GROUP BY,
window functions and CASE over the same parquet tables. Processing-time stamps
are left out on both sides.
"""

from __future__ import annotations

_MEM = """mem AS (
  SELECT c.c_custkey AS user_id, n.n_nationkey AS team_id, n.n_name AS team_name
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

_TEAMS = """tm AS (
  SELECT n.n_nationkey AS team_id, n.n_name AS dim_name,
         'DEPT_' || CAST(n.n_regionkey AS VARCHAR) AS department,
         CASE WHEN n.n_nationkey < 10 THEN 'Enterprise' ELSE 'Business' END AS plan_tier,
         CAST(n.n_nationkey * 200 AS DOUBLE) AS monthly_budget, r.r_name AS region
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""

_GOLD_COLS = """team_id, team_name, department, plan_tier, region, total_events, ai_api_calls,
  total_cost_usd, monthly_budget, budget_used_pct, avg_response_time_ms,
  CASE WHEN total_cost_usd > {hi} THEN 'HIGH' WHEN total_cost_usd > {mid} THEN 'MEDIUM'
       ELSE 'LOW' END AS cost_tier,
  CASE WHEN budget_used_pct > 100 THEN 'OVER_BUDGET' WHEN budget_used_pct > 80 THEN 'WARNING'
       ELSE 'ON_TRACK' END AS budget_status,
  period_start, period_end"""



def half_up(expr: str, digits: int) -> str:
    """Spark's ``round`` of a DOUBLE: HALF_UP on the value's shortest decimal
    text (DuckDB's ``round(double)`` differs at ties such as 29741.149999999998)."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


_PCT = half_up("total_cost_usd / CASE WHEN monthly_budget = 0 THEN NULL ELSE monthly_budget END"
               " * 100", 1) + " AS budget_used_pct"

_AGG = """agg AS (
  SELECT m.team_id, m.team_name,
         CAST(count(*) AS BIGINT) AS total_events,
         CAST(count(*) FILTER (WHERE e.event_type = 'purchase') AS BIGINT) AS ai_api_calls,
         CAST(round(sum(CAST(CASE WHEN e.event_type = 'purchase' THEN e.value ELSE 0.0 END AS DECIMAL(24, 6))), 4)
              AS DOUBLE) AS total_cost_usd,
         round(avg(CAST(floor(e.value * 10) AS INTEGER)), 1) AS avg_response_time_ms,
         min(e.ts) AS period_start, max(e.ts) AS period_end
  FROM events e LEFT JOIN mem m ON e.user_id = m.user_id
  GROUP BY m.team_id, m.team_name)"""

GOLD = f"""WITH {_MEM}, {_TEAMS}, {_AGG},
g AS (
  SELECT a.*, t.department, t.plan_tier, t.monthly_budget, t.region
  FROM agg a LEFT JOIN tm t ON a.team_id = t.team_id),
p AS (SELECT *, {_PCT} FROM g)
SELECT {_GOLD_COLS.format(hi=5000, mid=3000)} FROM p"""

GOLD_ALL_TEAMS = f"""WITH {_MEM}, {_TEAMS}, {_AGG},
g AS (
  SELECT t.team_id, coalesce(a.team_name, t.dim_name) AS team_name,
         t.department, t.plan_tier, t.monthly_budget, t.region,
         CAST(coalesce(a.total_events, 0) AS BIGINT) AS total_events,
         CAST(coalesce(a.ai_api_calls, 0) AS BIGINT) AS ai_api_calls,
         coalesce(a.total_cost_usd, 0.0) AS total_cost_usd,
         a.avg_response_time_ms, a.period_start, a.period_end
  FROM tm t LEFT JOIN agg a ON a.team_id = t.team_id),
p AS (SELECT *, {_PCT} FROM g)
SELECT {_GOLD_COLS.format(hi=5000, mid=3000)} FROM p"""

GOLD_QUIET_TEAMS = GOLD_ALL_TEAMS.replace("FROM tm t", """FROM (
    SELECT * FROM tm UNION ALL
    SELECT r_regionkey + 100, 'PLANNED_' || r_name, 'DEPT_' || CAST(r_regionkey AS VARCHAR), 'Business',
           CAST(r_regionkey * 200 AS DOUBLE), r_name
    FROM region) t""")

MONTHLY = f"""WITH {_MEM}, {_TEAMS},
agg AS (
  SELECT m.team_id, m.team_name, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month,
         CAST(count(*) AS BIGINT) AS total_events,
         CAST(count(*) FILTER (WHERE o.o_orderpriority = '1-URGENT') AS BIGINT) AS ai_api_calls,
         CAST(round(sum(CAST(CASE WHEN o.o_orderpriority = '1-URGENT' THEN o.o_totalprice ELSE 0.0 END
                             AS DECIMAL(24, 6))), 4) AS DOUBLE) AS total_cost_usd,
         round(avg(CAST(floor(o.o_totalprice) AS INTEGER)), 1) AS avg_response_time_ms,
         min(o.o_orderdate) AS period_start, max(o.o_orderdate) AS period_end
  FROM orders o LEFT JOIN mem m ON o.o_custkey = m.user_id
  GROUP BY 1, 2, 3),
g AS (
  SELECT a.*, t.department, t.plan_tier, t.monthly_budget, t.region
  FROM agg a LEFT JOIN tm t ON a.team_id = t.team_id),
p AS (SELECT *, {_PCT},
        (SELECT b.total_cost_usd FROM g b
         WHERE b.team_id IS NOT DISTINCT FROM g.team_id AND b.team_name IS NOT DISTINCT FROM g.team_name
           AND b.month = CAST(g.month - INTERVAL 1 MONTH AS DATE)) AS prev_month_cost_usd
      FROM g)
SELECT {_GOLD_COLS.format(hi=500000, mid=250000)}, month, prev_month_cost_usd,
       round(total_cost_usd - prev_month_cost_usd, 4) AS cost_change_usd
FROM p"""

TOP = f"""WITH gold AS ({GOLD})
SELECT team_name, plan_tier, total_events, ai_api_calls, total_cost_usd, monthly_budget,
       budget_used_pct, cost_tier, budget_status
FROM gold ORDER BY total_cost_usd DESC NULLS LAST, team_id LIMIT 20"""

PANEL_TOTALS = f"""WITH gold AS ({GOLD})
SELECT CAST(round(sum(CAST(total_cost_usd AS DECIMAL(24, 6))), 4) AS DOUBLE) AS total_cost_usd,
       CAST(sum(total_events) AS BIGINT) AS total_events,
       CAST(sum(ai_api_calls) AS BIGINT) AS ai_api_calls,
       CAST(count(*) AS BIGINT) AS teams,
       CAST(count(*) FILTER (WHERE budget_status = 'OVER_BUDGET') AS BIGINT) AS teams_over_budget
FROM gold"""

PANEL_SPEND = f"""WITH gold AS ({GOLD})
SELECT team_id, team_name, total_cost_usd, monthly_budget, budget_used_pct, budget_status
FROM gold"""

# Message feed as the oracle sees it: one row per delivered message with the
# fault key k; k = 9 rows are delivered twice.
_FEED = f"""WITH {_MEM},
b AS (
  SELECT e.*, m.team_id AS nation_id, m.team_name AS nation_name,
         CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k
  FROM events e LEFT JOIN mem m ON e.user_id = m.user_id),
d0 AS (
  SELECT k, 1 AS delivery, k BETWEEN 0 AND 6 OR nation_id IS NULL AS bad,
    CASE WHEN k = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS event_id,
    CASE WHEN k = 0 THEN NULL WHEN k = 10 THEN 'unknown' ELSE event_type END AS event_type,
    CASE WHEN k IN (0, 6) THEN NULL WHEN k = 1 THEN 'garbage'
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS event_ts,
    CASE WHEN k IN (0, 2, 6) THEN NULL ELSE 'team_' || CAST(nation_id AS VARCHAR) END AS team_id,
    CASE WHEN k = 0 THEN NULL ELSE nation_name END AS team_name,
    CASE WHEN k IN (0, 3) THEN NULL ELSE 'user_' || CAST(user_id AS VARCHAR) END AS user_id,
    CASE WHEN k IN (0, 4) THEN NULL WHEN k = 5 THEN 'a@b'
         ELSE 'user' || CAST(user_id AS VARCHAR) || '@example.com' END AS user_email,
    CAST(NULL AS VARCHAR) AS project_key, CAST(NULL AS VARCHAR) AS issue_id,
    CAST(NULL AS VARCHAR) AS priority,
    CASE WHEN k IN (0, 8) THEN NULL WHEN k = 11 THEN -1
         ELSE CAST(floor(value * 10) AS INTEGER) END AS response_time_ms,
    CASE WHEN k = 0 THEN NULL ELSE event_type = 'purchase' END AS ai_assist_used,
    CASE WHEN k = 0 THEN NULL ELSE 'events' END AS source_app
  FROM b),
d AS (SELECT * FROM d0 UNION ALL SELECT * REPLACE (2 AS delivery) FROM d0 WHERE k = 9)"""

_DECODED_COLS = """event_id, event_type, event_ts, team_id, team_name, user_id, user_email,
  project_key, issue_id, priority, response_time_ms, ai_assist_used, source_app"""

_TYPED_COLS = _DECODED_COLS.replace("event_ts,", "CAST(strptime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') AS TIMESTAMP) AS event_ts,")

DECODE = f"""{_FEED}
SELECT {_DECODED_COLS} FROM d"""

# a second delivery's response time is one more
DECODE_CHANGED = f"""{_FEED}
SELECT {_DECODED_COLS.replace("response_time_ms,", "response_time_ms + delivery - 1 AS response_time_ms,")} FROM d"""

_REASON = """CASE WHEN k = 0 THEN 'missing event_id'
       WHEN k IN (1, 6) THEN 'invalid timestamp'
       WHEN k = 2 OR team_id IS NULL THEN 'missing team_id'
       WHEN k = 3 THEN 'missing user_id'
       WHEN k = 4 THEN 'missing email'
       WHEN k = 5 THEN 'email too short' END"""

QUARANTINE = f"""{_FEED},
t AS (SELECT k, bad, {_TYPED_COLS.replace("CAST(strptime(", "CAST(try_strptime(")} FROM d)
SELECT {_DECODED_COLS}, {_REASON} AS quarantine_reason FROM t WHERE bad"""

# Silver: the last delivery of each valid event. In the changed feed a second
# delivery's response time is one more.
def _valid(changed: bool, extra: str = "") -> str:
    cols = _TYPED_COLS.replace("response_time_ms,", "response_time_ms + delivery - 1 AS response_time_ms,") \
        if changed else _TYPED_COLS
    return f"""{_FEED},
t AS (SELECT {cols}{extra} FROM d WHERE NOT bad
      QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY delivery DESC) = 1)
SELECT *, event_type = 'purchase' AS is_ai_event,
       CASE WHEN event_type = 'purchase' THEN 0.000126 ELSE 0.0 END AS cost_estimate_usd
FROM t"""


VALID = _valid(True)
VALID_FIRST = _valid(False)

_AUDIT_COLS = """CAST(count(*) AS BIGINT) AS rows_in,
       CAST(count(*) FILTER (WHERE bad) AS BIGINT) AS rows_quarantined,
       CAST(count(*) FILTER (WHERE NOT bad) AS BIGINT) AS rows_valid,
       CAST(count(DISTINCT CASE WHEN NOT bad THEN event_id END) AS BIGINT) AS rows_out,
       CAST(count(*) FILTER (WHERE NOT bad)
            - count(DISTINCT CASE WHEN NOT bad THEN event_id END) AS BIGINT) AS duplicates_removed"""

AUDIT_EVENTS = f"""{_FEED}
SELECT {_AUDIT_COLS}
FROM d"""

LATEST = """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, l_partkey, l_suppkey) AS rn
  FROM lineitem) WHERE rn = 1"""

AUDIT_LINEITEM = """SELECT CAST(count(*) AS BIGINT) AS rows_in, CAST(0 AS BIGINT) AS rows_quarantined,
       CAST(count(*) AS BIGINT) AS rows_valid,
       CAST((SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS BIGINT)
         AS rows_out,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
            AS BIGINT) AS duplicates_removed
FROM lineitem"""

ENRICH = """SELECT *, event_type = 'purchase' AS is_ai_event,
       CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END AS cost_estimate_usd
FROM events"""


def _sessions_body(keys: str, src: str = "events", ts: str = "ts") -> str:
    """CTEs + final SELECT of gap-based sessions (30 minutes, inclusive)."""
    return f"""g AS (
  SELECT {keys}, {ts} AS ts,
         CASE WHEN {ts} - lag({ts}) OVER (PARTITION BY {keys} ORDER BY {ts}) <= INTERVAL 30 MINUTE
              THEN 0 ELSE 1 END AS brk
  FROM {src} WHERE {ts} IS NOT NULL),
x AS (SELECT *, sum(brk) OVER (PARTITION BY {keys} ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid
      FROM g)
SELECT {keys}, min(ts) AS session_start, max(ts) AS session_end,
       CAST(count(*) AS BIGINT) AS events_in_session,
       (floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 60.0 AS session_duration_minutes
FROM x GROUP BY {keys}, sid"""


def _sessions(keys: str) -> str:
    return "WITH " + _sessions_body(keys)


AVG_SESSION = f"""WITH {_MEM}, s AS ({_sessions("user_id")})
SELECT m.team_id, m.team_name, CAST(count(*) AS BIGINT) AS sessions,
       round(sum(s.session_duration_minutes) / count(*), 2) AS avg_session_minutes
FROM s LEFT JOIN mem m ON s.user_id = m.user_id
GROUP BY m.team_id, m.team_name"""


def _suite(src: str, rt: str, types: str) -> str:
    """Result rows of the eight checks over ``src`` (a FROM-able relation)."""
    return f"""m AS (
  SELECT count(*) AS total,
         count(*) FILTER (WHERE event_id IS NULL) AS n1,
         count(*) FILTER (WHERE event_type NOT IN ({types})) AS n2,
         count(*) FILTER (WHERE {rt} < 0 OR {rt} > 5000) AS n3,
         count(*) FILTER (WHERE cost_estimate_usd < 0) AS n4,
         count(*) FILTER (WHERE is_ai_event IS NULL) AS n5,
         (SELECT count(*) FROM (SELECT DISTINCT event_id FROM {src})) AS n6,
         count(*) FILTER (WHERE is_ai_event AND cost_estimate_usd = 0) AS n8a,
         count(*) FILTER (WHERE NOT is_ai_event AND cost_estimate_usd > 0) AS n8b
  FROM {src}),
r AS (
  SELECT 'event_id_not_null' AS "check", 'every row has a value in event_id' AS description,
         n1 = 0 AS ok, CAST(n1 AS VARCHAR) || ' null values in event_id' AS details FROM m
  UNION ALL
  SELECT 'event_type_valid_values',
         'event_type takes known values only: signup, error, click, view, purchase',
         n2 = 0, CAST(n2 AS VARCHAR) || ' values of event_type that are not known' FROM m
  UNION ALL
  SELECT 'response_time_in_range', '{rt} lies in [0, 5000]',
         n3 = 0, CAST(n3 AS VARCHAR) || ' values of {rt} beyond [0, 5000] ms' FROM m
  UNION ALL
  SELECT 'cost_not_negative', 'cost_estimate_usd is never below zero',
         n4 = 0, CAST(n4 AS VARCHAR) || ' values of cost_estimate_usd below zero' FROM m
  UNION ALL
  SELECT 'is_ai_event_not_null', 'every row has a value in is_ai_event',
         n5 = 0, CAST(n5 AS VARCHAR) || ' null values in is_ai_event' FROM m
  UNION ALL
  SELECT 'no_duplicate_event_ids', 'each event_id occurs once',
         n6 >= total, CAST(total - n6 AS VARCHAR) || ' repeated values of event_id' FROM m
  UNION ALL
  SELECT 'minimum_row_count', 'Silver holds 100 rows or more',
         total >= 100, CAST(total AS VARCHAR) || ' rows; the minimum is 100' FROM m
  UNION ALL
  SELECT 'ai_cost_consistency',
         'a flagged event costs something and any other nothing',
         n8a = 0 AND n8b = 0,
         CAST(n8a AS VARCHAR) || ' flagged events without cost, ' || CAST(n8b AS VARCHAR)
           || ' other events with cost' FROM m)"""


_TYPES = "'signup', 'error', 'click', 'view', 'purchase'"

EXPECTATIONS = f"""WITH pe AS ({ENRICH}), {_suite("pe", "value", _TYPES)}
SELECT "check", description, CASE WHEN ok THEN 'PASSED' ELSE 'FAILED' END AS status, details
FROM r"""

_FAILING_SRC = f"""{_FEED},
fs AS (SELECT {_TYPED_COLS.replace("CAST(strptime(", "CAST(try_strptime(")},
              coalesce(event_type = 'purchase', false) AS is_ai_event,
              CASE WHEN event_type = 'purchase' THEN 0.000126 ELSE 0.0 END AS cost_estimate_usd
       FROM d)"""

EXPECTATIONS_FAILING = f"""{_FAILING_SRC}, {_suite("fs", "response_time_ms", _TYPES)}
SELECT "check", description, CASE WHEN ok THEN 'PASSED' ELSE 'FAILED' END AS status, details
FROM r"""

QUALITY_SCORE = f"""{_FAILING_SRC}, {_suite("fs", "response_time_ms", _TYPES)}
SELECT 'medallion' AS pipeline, 'silver_jira_events_clean' AS "table",
       CAST((SELECT total FROM m) AS BIGINT) AS total_rows_checked,
       CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS checks_passed,
       CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS checks_failed,
       round(count(*) FILTER (WHERE ok) / count(*) * 100, 1) AS quality_score_pct
FROM r"""

def _run_score(results_sql: str) -> str:
    return f"""SELECT round(count(*) FILTER (WHERE status = 'PASSED') / count(*) * 100, 1) AS score,
       count(*) FILTER (WHERE status <> 'PASSED') AS failed
FROM ({results_sql})"""


QUALITY_HISTORY = f"""WITH runs AS ({_run_score(EXPECTATIONS)}
  UNION ALL {_run_score(EXPECTATIONS_FAILING)})
SELECT 'medallion' AS pipeline, 'silver_jira_events_clean' AS "table",
       CAST(count(*) AS BIGINT) AS runs, {half_up("avg(score)", 1)} AS avg_score_pct,
       min(score) AS min_score_pct, CAST(sum(failed) AS BIGINT) AS checks_failed
FROM runs"""

# The whole run: Gold over the Silver rows of VALID, teams keyed "team_<n>",
# unit costs and budgets by team number, the original cost tiers (1.0 / 0.5).
_TEAM_NO = "CAST(split_part(team_id, '_', 2) AS INTEGER)"
_RUN_SILVER = f"""s AS (
  SELECT * REPLACE (CASE WHEN is_ai_event THEN [0.002, 0.01, 0.05][{_TEAM_NO} % 3 + 1] ELSE 0 END AS cost_estimate_usd)
  FROM ({VALID}))"""
_RUN_TEAMS = (_TEAMS.replace("SELECT n.n_nationkey AS team_id", "SELECT 'team_' || CAST(n.n_nationkey AS VARCHAR) AS team_id")
              .replace("CAST(n.n_nationkey * 200 AS DOUBLE)", "CAST([0.0, 0.5, 4.0, 1.0, 100.0][n.n_nationkey % 5 + 1] AS DOUBLE)"))
MEDALLION_GOLD = f"""WITH {_RUN_SILVER},
{_RUN_TEAMS},
agg AS (
  SELECT team_id, team_name, CAST(count(*) AS BIGINT) AS total_events,
         CAST(count(*) FILTER (WHERE is_ai_event) AS BIGINT) AS ai_api_calls,
         CAST(round(sum(CAST(cost_estimate_usd AS DECIMAL(24, 6))), 4) AS DOUBLE) AS total_cost_usd,
         {half_up("avg(response_time_ms)", 1)} AS avg_response_time_ms,
         min(event_ts) AS period_start, max(event_ts) AS period_end
  FROM s GROUP BY team_id, team_name),
g AS (
  SELECT a.*, t.department, t.plan_tier, t.monthly_budget, t.region
  FROM agg a LEFT JOIN tm t ON a.team_id = t.team_id),
p AS (SELECT *, {_PCT} FROM g)
SELECT {_GOLD_COLS.format(hi=1.0, mid=0.5)} FROM p"""

MEDALLION_QUALITY = f"""WITH {_RUN_SILVER}, {_suite("s", "response_time_ms", _TYPES)}
SELECT "check", description, CASE WHEN ok THEN 'PASSED' ELSE 'FAILED' END AS status, details
FROM r"""

SILVER_SESSIONS = f"""WITH silver AS ({VALID}), """ + _sessions_body("user_id, team_id, team_name", "silver", "event_ts")

MEDALLION_AUDIT = f"""WITH a AS ({_FEED}
SELECT {_AUDIT_COLS}
FROM d)
SELECT a.*, CAST((SELECT count(*) FROM ({SILVER_SESSIONS})) AS BIGINT) AS sessions FROM a"""

# Page-event (Confluence-shaped) feed; k = 9 delivered twice.
_PFEED = f"""WITH {_MEM},
b AS (
  SELECT e.*, m.team_id AS nation_id, m.team_name AS nation_name,
         CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k
  FROM events e LEFT JOIN mem m ON e.user_id = m.user_id),
p0 AS (
  SELECT k, k BETWEEN 0 AND 6 OR nation_id IS NULL AS bad,
    CASE WHEN k = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS event_id,
    CASE WHEN k = 0 THEN NULL ELSE event_type END AS event_type,
    CASE WHEN k IN (0, 1) THEN NULL ELSE TIMESTAMP '2024-01-01' + (ts - date_trunc('day', ts)) END AS event_ts,
    CASE WHEN k IN (0, 2) THEN NULL ELSE 'team_' || CAST(nation_id AS VARCHAR) END AS team_id,
    CASE WHEN k = 0 THEN NULL ELSE nation_name END AS team_name,
    CASE WHEN k IN (0, 3) THEN NULL ELSE 'user_' || CAST(user_id % 2 AS VARCHAR) END AS user_id,
    CASE WHEN k = 0 THEN NULL ELSE 'user' || CAST(user_id AS VARCHAR) || '@example.com' END
      AS user_email,
    CASE WHEN k IN (0, 4, 6) THEN NULL ELSE upper(substr(event_type, 1, 4)) END AS space_key,
    CASE WHEN k IN (0, 5, 6) THEN NULL ELSE 'PAGE-' || CAST(k % 4 AS VARCHAR) END AS page_id,
    CASE WHEN k = 0 THEN NULL ELSE 'Page ' || CAST(k AS VARCHAR) END AS page_title,
    CASE WHEN k = 0 THEN NULL ELSE CAST(floor(value * 10) AS INTEGER) END AS response_time_ms,
    CASE WHEN k = 0 THEN NULL ELSE event_type = 'purchase' END AS ai_assist_used,
    CASE WHEN k = 0 THEN NULL ELSE 'confluence' END AS source_app
  FROM b),
p AS (SELECT * FROM p0 UNION ALL SELECT * FROM p0 WHERE k = 9)"""

_PAGE_COLS = """event_id, event_type, event_ts, team_id, team_name, user_id, user_email,
  space_key, page_id, page_title, response_time_ms, ai_assist_used, source_app"""

CONFLUENCE_QUARANTINE = f"""{_PFEED}
SELECT {_PAGE_COLS},
  CASE WHEN k = 0 THEN 'missing event_id' WHEN k = 1 THEN 'invalid timestamp'
       WHEN k = 2 OR team_id IS NULL THEN 'missing team_id' WHEN k = 3 THEN 'missing user_id'
       WHEN k IN (4, 6) THEN 'missing space_key' WHEN k = 5 THEN 'missing page_id' END
    AS quarantine_reason
FROM p WHERE bad"""

STREAM_INGEST_BOTH = f"""SELECT * FROM (
  SELECT 'jira' AS feed, t.* FROM ({_FEED}
    SELECT {_TYPED_COLS.replace("CAST(strptime(", "CAST(try_strptime(")} FROM d) t
  UNION ALL BY NAME
  SELECT 'confluence' AS feed, t.* FROM ({_PFEED}
    SELECT {_PAGE_COLS} FROM p) t)"""

CONFLUENCE_VALID = f"""{_PFEED},
t AS (SELECT DISTINCT {_PAGE_COLS} FROM p WHERE NOT bad)
SELECT *, event_type = 'purchase' AS is_ai_event,
       CASE WHEN event_type = 'purchase' THEN 0.000126 ELSE 0.0 END AS cost_estimate_usd
FROM t"""

CONFLUENCE_PAGE_SESSIONS = (
    f"""{_PFEED},
pv AS (SELECT DISTINCT {_PAGE_COLS} FROM p WHERE NOT bad),
""" + _sessions_body("user_id, team_id, team_name, space_key, page_id", "pv", "event_ts"))

CONFLUENCE_SESSIONS = CONFLUENCE_PAGE_SESSIONS

UNKNOWN_MEMBERS = GOLD.replace("ON c.c_nationkey = n.n_nationkey)", "ON c.c_nationkey = n.n_nationkey WHERE c.c_custkey % 7 <> 3)", 1)

ROUNDING_TIES = """SELECT CAST(floor(event_id / 75) AS BIGINT) AS team_id, 'T' AS team_name,
       CAST(count(*) AS BIGINT) AS total_events, CAST(count(*) AS BIGINT) AS ai_api_calls,
       CAST(round(CAST(0.000126 AS DECIMAL(24, 6)) * count(*), 4) AS DOUBLE) AS total_cost_usd,
       """ + half_up("avg(CAST(floor(value * 10) AS INTEGER))", 1) + """ AS avg_response_time_ms,
       min(ts) AS period_start, max(ts) AS period_end
FROM events GROUP BY 1"""

STAGED = " UNION ALL ".join(
    f"SELECT '{t}' AS dimension, CAST({k} AS BIGINT) AS key, {n} AS name, 'testdata_{t}' AS source, true AS stamped FROM {t}"
    for t, k, n in (("customer", "c_custkey", "c_name"), ("nation", "n_nationkey", "n_name"),
                    ("region", "r_regionkey", "r_name")))

# A delivery's arrival minute in the stepped feed; the copy that arrived last stays.
_STEP = "CAST((CAST({id} AS BIGINT) + delivery - 1) % 6 AS INTEGER)"
_LAST = f"[0, 60, 120, 5, 30, 121][{_STEP.format(id='event_id')} + 1]"
SILVER_REPLAYED = _valid(True).replace("ORDER BY delivery DESC", f"ORDER BY {_LAST} DESC")
STREAM_TWO_SINKS = f"""WITH s AS ({SILVER_REPLAYED}), q AS ({QUARANTINE}), a AS ({AUDIT_EVENTS})
SELECT 'silver' AS sink, event_id, CAST(response_time_ms AS VARCHAR) AS detail, CAST(1 AS BIGINT) AS n FROM s
UNION ALL SELECT 'quarantine', event_id, quarantine_reason, 1 FROM q
UNION ALL SELECT 'audit', NULL, detail, n FROM (
  SELECT unnest(['rows_in', 'rows_quarantined', 'rows_valid', 'rows_new', 'duplicates_removed']) AS detail,
         unnest([rows_in, rows_quarantined, rows_valid, rows_out, duplicates_removed]) AS n FROM a)"""

ID_INDEX = f"""{_FEED},
i AS (SELECT d.event_id AS id, count(*) AS n, max(delivery) - min(delivery) AS spread FROM d WHERE k <> 0 GROUP BY 1
      UNION ALL SELECT NULL, count(*), 1 FROM d WHERE k = 0 HAVING count(*) > 0)
SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS distinct_ids, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows,
       CAST(count(*) FILTER (spread > 0) AS BIGINT) AS ids_on_several_days FROM i"""

SCHEMA_EVOLUTION = """SELECT CAST(c_custkey + CASE WHEN c_custkey % 3 = 1 THEN 1099511627776 ELSE 0 END AS BIGINT) AS id, c_name AS name,
       CASE WHEN c_custkey % 3 = 1 THEN c_nationkey + 0.1::DOUBLE ELSE c_nationkey::DOUBLE END AS score,
       CASE WHEN c_custkey % 3 = 1 THEN c_mktsegment END AS segment,
       CASE WHEN c_custkey % 3 < 2 THEN 'standard' WHEN c_acctbal > 0 THEN 'gold' END AS tier
FROM customer"""

ORACLE: dict[str, str] = {
    "team_cost_unknown_members": UNKNOWN_MEMBERS,
    "team_cost_rounding_ties": ROUNDING_TIES,
    "staged_dimensions": STAGED,
    "medallion_audit": MEDALLION_AUDIT,
    "confluence_medallion_sessions": CONFLUENCE_SESSIONS,
    "stream_silver_batches": VALID_FIRST,
    "team_cost_summary": GOLD,
    "team_cost_summary_all_teams": GOLD_ALL_TEAMS,
    "team_cost_quiet_teams": GOLD_QUIET_TEAMS,
    "team_cost_monthly": MONTHLY,
    "team_cost_top": TOP,
    "panel_totals": PANEL_TOTALS,
    "panel_spend_by_team": PANEL_SPEND,
    "decode_events": DECODE,
    "quarantine": QUARANTINE,
    "valid_events": VALID,
    "silver_audit_events": AUDIT_EVENTS,
    "latest_per_key": LATEST,
    "silver_audit": AUDIT_LINEITEM,
    "enrich_events": ENRICH,
    "user_sessions": _sessions("user_id"),
    "user_page_sessions": _sessions("user_id, event_type"),
    "avg_session_by_team": AVG_SESSION,
    "expectations": EXPECTATIONS,
    "expectations_failing": EXPECTATIONS_FAILING,
    "quality_score": QUALITY_SCORE,
    "quality_history": QUALITY_HISTORY,
    "medallion_gold": MEDALLION_GOLD,
    "medallion_quality": MEDALLION_QUALITY,
    "silver_user_sessions": SILVER_SESSIONS,
    "confluence_quarantine": CONFLUENCE_QUARANTINE,
    "confluence_valid_events": CONFLUENCE_VALID,
    "confluence_page_sessions": CONFLUENCE_PAGE_SESSIONS,
    "stream_ingest": DECODE,
    "stream_ingest_both": STREAM_INGEST_BOTH,
    "stream_silver": VALID_FIRST,
    "stream_quarantine": QUARANTINE,
    "stream_sessions": _sessions("user_id"),
    "stream_two_sinks": STREAM_TWO_SINKS,
    "stream_silver_replayed": SILVER_REPLAYED,
    "stream_supervised": DECODE_CHANGED,
    "replace_after_failure": "SELECT * FROM orders",
    "gate_blocks": GOLD,
    "dimension_increments": "SELECT *, '2024-03-10 00:00:00' AS mark FROM customer",
    "session_increments": _sessions("user_id, event_type"),
    "gold_increments": GOLD,
    "id_index": ID_INDEX,
    "schema_evolution": SCHEMA_EVOLUTION,
}
