from pyspark.sql import functions as F

from conftest import rows
from tidewater.operators.audit import audit_counts
from tidewater.operators.dedup import latest_per_key
from tidewater.operators.enrich import enrich_cost


def test_latest_with_tie_breaker(spark):
    df = spark.createDataFrame([
        ("a", 1, "x1"), ("a", 3, "x3"), ("a", 3, "x2"),   # tie on ts: tie-breaker decides
        ("b", 5, "y"),                                    # single row
    ], "k string, ts int, v string")
    out = latest_per_key(df, ["k"], [F.col("ts").desc()], [F.col("v").asc()])
    assert sorted(rows(out)) == [("a", 3, "x2"), ("b", 5, "y")]
    # idempotent
    again = latest_per_key(out, ["k"], [F.col("ts").desc()], [F.col("v").asc()])
    assert sorted(rows(again)) == sorted(rows(out))


def test_top1_is_planned_with_partial_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("ts"))
    out = latest_per_key(df, ["k"], [F.col("ts").desc()])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert sorted(rows(out)) == [(k, max(i for i in range(1000) if i % 7 == k)) for k in range(7)]


def test_audit_counts_one_pass(spark):
    df = spark.createDataFrame([("a", True), ("a", True), ("b", True), ("c", False)],
                               "k string, ok boolean")
    r = audit_counts(df, ["k"], F.col("ok")).collect()[0].asDict()
    assert r == {"rows_in": 4, "rows_quarantined": 1, "rows_valid": 3, "rows_out": 2,
                 "duplicates_removed": 1}


def test_enrich_flag_never_null(spark):
    df = spark.createDataFrame([("ai_assist",), ("issue_created",), (None,)], "event_type string")
    out = rows(enrich_cost(df, stamp_col=None))
    assert out == [("ai_assist", True, 0.000126), ("issue_created", False, 0.0), (None, False, 0.0)]
