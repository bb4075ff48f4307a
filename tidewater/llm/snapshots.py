"""Collapse of cumulative conversation snapshots, then chat formatting.

A logging client that stores a conversation after every turn leaves many
conversations that are turn prefixes of longer ones. A rolling hash names
every turn prefix: the sum over its turns of two independent 64-bit hashes of
(position, role, text), kept as four sums of 32-bit halves. A conversation
whose whole hash is a proper prefix hash of another is dropped by an anti-join;
of equal conversations the one with the smallest id stays. The maximal ones
are rendered, a block per turn.

Positions and running sums are built in two levels, over blocks of turn
numbers and then over the blocks of a conversation, so that no task has to
hold a long conversation's turns.

Defined results: turns are ordered by turn number, null first; ties go by role
and then by content hash. A null role is rendered as ``unknown`` and a null
text as empty, but both differ from given values when conversations are
compared. Rows with a null conv_id form one conversation. Repeated rows are
turns of their own. An empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import materialize, table

BLOCK = 256               # turn numbers in a block
TURN_FORMAT = ("<|", "|>\n", "<|end|>\n")
_HALF = (1 << 32) - 1
_SUMS = ["s1", "s2", "s3", "s4"]
_ORDER = ["turn", "role", "h1", "h2"]




def turn_hashes(turns: DataFrame) -> DataFrame:
    parts = [F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(),
             F.coalesce("text", F.lit(""))]
    return turns.select("conv_id", "turn", "role", "text", F.xxhash64(F.lit(1), *parts).alias("h1"),
                        F.xxhash64(F.lit(2), *parts).alias("h2"))


def prefix_hashes(hashed: DataFrame) -> DataFrame:
    """(conv_id, k, n, four sums) for every turn prefix of k of a conversation's n turns."""
    slim = hashed.select("conv_id", "turn", "role", "h1", "h2",
                         F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))).alias("block"))
    local = slim.withColumn("at", F.row_number().over(Window.partitionBy("conv_id", "block").orderBy(*_ORDER)))
    by_conv = Window.partitionBy("conv_id")
    earlier = by_conv.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (slim.groupBy("conv_id", "block").agg(F.count("*").alias("size"))
             .withColumn("before", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
             .withColumn("n", F.sum("size").over(by_conv)).drop("size"))
    k = F.col("before") + F.col("at")
    placed = (local.join(sizes.withColumnsRenamed({"conv_id": "c", "block": "b"}),
                         F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")))
              .select("conv_id", "block", "n", k.alias("k"), F.xxhash64(k, "h1", F.lit(1)).alias("e1"),
                      F.xxhash64(k, "h2", F.lit(2)).alias("e2")))
    halves = {"s1": F.col("e1").bitwiseAND(_HALF), "s2": F.shiftrightunsigned("e1", 32),
              "s3": F.col("e2").bitwiseAND(_HALF), "s4": F.shiftrightunsigned("e2", 32)}
    placed = materialize(placed.select("conv_id", "block", "n", "k", *[v.alias(c) for c, v in halves.items()]),
                         "turns")
    running = Window.partitionBy("conv_id", "block").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    local = placed.select("conv_id", "block", "n", "k", *[F.sum(c).over(running).alias(c) for c in _SUMS])
    blocks = (placed.groupBy("conv_id", "block").agg(*[F.sum(c).alias(c) for c in _SUMS])
              .select(F.col("conv_id").alias("c"), F.col("block").alias("b"),
                      *[F.coalesce(F.sum(c).over(Window.partitionBy("conv_id").orderBy("block")
                                                 .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"{c}_b")
                        for c in _SUMS]))
    return (local.join(blocks, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")))
            .select("conv_id", "k", "n", *[(F.col(c) + F.col(f"{c}_b")).alias(c) for c in _SUMS]))


def maximal_conversations(hashed: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies) of the conversations that no other one extends."""
    prefixes = materialize(prefix_hashes(hashed), "prefixes")
    whole = (prefixes.where("k = n").groupBy("k", *_SUMS)
             .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies")))
    proper = prefixes.where("k < n").select("k", *_SUMS).distinct()
    return (whole.join(proper, ["k", *_SUMS], "left_anti")
            .select("conv_id", F.col("k").cast("long").alias("n_turns"), "n_copies"))


def render(hashed: DataFrame, kept: DataFrame) -> DataFrame:
    """``kept`` with the rendered text of each conversation in ``chat``."""
    head, mid, tail = TURN_FORMAT
    block = F.concat(F.lit(head), F.coalesce("role", F.lit("unknown")), F.lit(mid),
                     F.coalesce("text", F.lit("")), F.lit(tail))
    ids = kept.select(F.col("conv_id").alias("kept_id"), "n_turns", "n_copies")
    turns = hashed.join(ids, F.col("conv_id").eqNullSafe(F.col("kept_id")))
    ordered = F.sort_array(F.collect_list(F.struct(*_ORDER, block.alias("block"))))
    return (turns.groupBy("conv_id", "n_turns", "n_copies")
            .agg(F.array_join(F.transform(ordered, lambda t: t["block"]), "").alias("chat")))


def op10_snapshot_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = turn_hashes(table(spark, sf_dir, "conversations"))
    return render(hashed, maximal_conversations(hashed))


OP10_SQL = """
WITH t AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) AS k
           FROM conversations),
p AS (SELECT conv_id, k, count(*) OVER (PARTITION BY conv_id) AS n,
             string_agg(coalesce(role, chr(29)) || chr(31) || coalesce(text, chr(29)), chr(30))
               OVER (PARTITION BY conv_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS whole
      FROM t),
f AS (SELECT whole, n AS n_turns, min(conv_id) AS conv_id, count(*) AS n_copies FROM p WHERE k = n GROUP BY whole, n),
m AS (SELECT * FROM f WHERE whole NOT IN (SELECT whole FROM p WHERE k < n)),
r AS (SELECT conv_id, string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '')
                                 || '<|end|>' || chr(10), '' ORDER BY k) AS chat FROM t GROUP BY conv_id)
SELECT m.conv_id, n_turns, n_copies, chat FROM m JOIN r ON m.conv_id IS NOT DISTINCT FROM r.conv_id
"""
