"""Keyed merges into a versioned table: the latest row of a key wins, whatever order rows arrive in."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.session import remove_path, scratch_path
from tidewater.sinks.lake import Change, Partition

NEW, WINS, LOSES = "new", "wins", "loses"


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row's key, a partition column of merged tables."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _texts(df: DataFrame, partition_by: Sequence[str]) -> set[tuple]:
    """Distinct partitions of ``df`` as folder values; as many rows as there are partitions."""
    picked = df.select(*[F.col(c).cast("string") for c in partition_by]).distinct().collect()
    return {tuple(r) for r in picked}


def _within(partitions: set[tuple], partition_by: Sequence[str]):
    def holds(p: Partition) -> bool:
        return tuple(p[c] for c in partition_by) in partitions

    return holds


def replace_touched(change: Change, table: str, rows: DataFrame, partition_by: Sequence[str]) -> None:
    """Replace the partitions that ``rows`` has; all others stay (a day that is loaded again, say)."""
    change.replace_partitions(table, rows, _within(_texts(rows, partition_by), partition_by), partition_by=partition_by)


def upsert(change: Change, table: str, rows: DataFrame, keys: Sequence[str], order: Sequence[str],
           partition_by: Sequence[str]) -> dict[str, int]:
    """Merge ``rows``, one per key, into ``table``: of two rows of a key the one with the larger
    ``order`` values stays (NULL is smallest; the table's on a full tie).

    A key is looked for in the partitions that ``rows`` has, so the partition
    columns must follow from the key for a merge by key alone
    (:func:`key_bucket`); a column that doesn't (a date) becomes part of the key.
    Of the table only keys and order columns of those partitions are read, and
    only partitions in which a row is replaced are written again; all other rows
    are appended. Returns how many rows were new, won and lost.
    """
    spark = rows.sparkSession
    partition_by, order = list(partition_by), list(order)
    identity = [*keys, *[c for c in partition_by if c not in keys]]
    path = scratch_path(spark, "upsert")
    if change.has(table):
        held = change.read(table, _within(_texts(rows, partition_by), partition_by))
        old = held.select(*[F.col(c).alias(f"_old_{c}") for c in identity],
                          F.struct(*order).alias("_old_order"), F.lit(True).alias("_held"))
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in identity])
        state = (F.when(F.col("_held").isNull(), NEW)
                 .when(F.struct(*order) > F.col("_old_order"), WINS).otherwise(LOSES))
        judged = rows.join(old, same, "left").select(*rows.columns, state.alias("_state"))
    else:
        judged = rows.withColumn("_state", F.lit(NEW))
    judged.write.parquet(path)   # read three times below; cuts the lineage
    judged = spark.read.schema(judged.schema).parquet(path)

    counts = {NEW: 0, WINS: 0, LOSES: 0} | {r["_state"]: r["count"] for r in judged.groupBy("_state").count().collect()}
    out = judged.filter(F.col("_state") != LOSES).drop("_state")
    touched: set[tuple] = set()
    if counts[WINS]:
        won = judged.filter(F.col("_state") == WINS)
        touched = _texts(won, partition_by)
        gone = won.select(*[F.col(c).alias(f"_old_{c}") for c in identity])
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in identity])
        kept = change.read(table, _within(touched, partition_by)).join(gone, same, "left_anti")
        out = out.unionByName(kept, allowMissingColumns=True)
    change.replace_partitions(table, out.repartition(*partition_by), _within(touched, partition_by),
                              partition_by=partition_by)
    remove_path(spark, path)
    return counts


def merge_changes(change: Change, table: str, rows: DataFrame, keys: Sequence[str], changed_at: str,
                  buckets: int = 64) -> dict[str, int]:
    """An increment of changed rows: the latest row per key by ``changed_at``, and the increment's mark.

    The mark (``<table>.mark``, the largest ``changed_at`` seen, as text) is
    committed with the data. A repeated increment changes nothing: all its rows
    lose against themselves.
    """
    from tidewater.operators.dedup import latest_per_key

    hashed = rows.withColumn("_row_hash", F.xxhash64(*rows.columns)).withColumn("_bucket", key_bucket(keys, buckets))
    latest = latest_per_key(hashed, [*keys], [F.col(changed_at).desc(), F.col("_row_hash").desc()])
    counts = upsert(change, table, latest, keys, [changed_at, "_row_hash"], ["_bucket"])
    known = change.mark(f"{table}.mark")
    newest = F.greatest(F.max(changed_at), F.lit(known).cast(rows.schema[changed_at].dataType))   # skips NULL
    change.set_mark(f"{table}.mark", rows.agg(newest.cast("string").alias("mark")).first()["mark"])
    return counts


__all__ = ["key_bucket", "merge_changes", "replace_touched", "upsert"]
