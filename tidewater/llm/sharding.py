"""Reproducible global shuffle into equal shards by a Feistel permutation.

Every row gets its global row number in the order of (id, the digest columns).
A Feistel network over ``a x b >= rows`` numbers, walked on from numbers
beyond the last row until one inside is met (cycle walking), permutes the row
numbers; the permuted number modulo the shard count is the shard and its
quotient the slot. Shard and slot of a row are computable from its row number,
the row count and the seed alone; shard counts differ by one row at most (law
``rows``) and slots have no gaps.

Defined results: null ids come first, and null texts count as no bytes with
the checksum of the empty text. Ties and repeated rows take consecutive row
numbers in any order, so equal rows may swap places but the shards' contents
are the same. An empty table gives an empty table. Columns of the input that
clash with ``row_number``, ``shard`` or ``slot`` are replaced by the results.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import materialize, shuffle_tasks, table, utf8_len

SHARDS = 40
SEED = 20_240_601
ROUNDS = 6
PRIME = 2_147_483_647     # of the round function; products stay below 2^62
ROW_OVERHEAD = 16         # bytes counted for a row beside its text


def round_keys(seed: int = SEED) -> list[tuple[int, int]]:
    """Multiplier and increment of each round."""
    rng = random.Random(seed)
    return [(rng.randrange(1, PRIME), rng.randrange(PRIME)) for _ in range(ROUNDS)]


def halves(rows: int) -> tuple[int, int]:
    """Sides ``a, b`` of the least near-square domain that holds all rows."""
    a = max(1, math.isqrt(max(rows, 1) - 1) + 1)
    return a, max(1, -(-rows // a))


def _permute(p: Column, a: int, b: int, seed: int) -> Column:
    keys = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(c).cast("long").alias("c"),
                              F.lit(i % 2).alias("side")) for i, (m, c) in enumerate(round_keys(seed))])

    def mixed(x: Column, k: Column) -> Column:
        y = (x * k["m"] + k["c"]) % PRIME
        return (y * y) % PRIME

    def step(s: Column, k: Column) -> Column:
        left = F.when(k["side"] == 0, (s["l"] + mixed(s["r"], k)) % a).otherwise(s["l"])
        right = F.when(k["side"] == 1, (s["r"] + mixed(s["l"], k)) % b).otherwise(s["r"])
        return F.struct(left.alias("l"), right.alias("r"))

    start = F.struct(F.floor(p / F.lit(b)).cast("long").alias("l"), (p % b).cast("long").alias("r"))
    if a * b > 1 << 52:   # beyond exact doubles
        raise ValueError("more rows than the permutation's domain holds")
    return F.aggregate(keys, start, step, lambda s: s["l"] * b + s["r"])


def permuted(row: Column, rows: int, seed: int = SEED) -> Column:
    """The shuffled place of a row number below ``rows``."""
    a, b = halves(rows)
    first = _permute(row, a, b, seed)
    # a cycle leaves the domain's surplus after as many steps as it has numbers at most
    surplus = a * b - rows
    if not surplus:
        return first
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(surplus)), first,
                       lambda p, _: F.when(p < rows, p).otherwise(_permute(p, a, b, seed)))
    return F.when(first < rows, first).otherwise(walk)


def numbered(df: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``df`` with the global row number in ``order``, and the row count.

    Rows are range-partitioned and sorted; a row's number is its place in its
    partition plus the rows of the partitions before. Equal rows are dealt to
    several partitions by a running id.
    """
    spark = df.sparkSession
    tie = F.monotonically_increasing_id()
    placed = (df.drop("row_number").withColumn("_tie", tie)
              .repartitionByRange(shuffle_tasks(spark), *order, "_tie")
              .sortWithinPartitions(*order, "_tie").drop("_tie")
              .withColumn("_at", F.monotonically_increasing_id()))
    placed = materialize(placed, "numbered")
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # a row per partition
    parts = (placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
             .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))))
    rows = parts.agg(F.sum("_n")).first()[0] or 0
    out = (placed.withColumn("_part", part).join(F.broadcast(parts.drop("_n")), "_part")
           .withColumn("row_number", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1))
           .drop("_part", "_before", "_at"))
    return out, rows


def assign_shards(df: DataFrame, order: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """All columns of ``df`` with ``row_number``, ``shard`` and ``slot``."""
    rows, n = numbered(df, order)
    p = permuted(F.col("row_number"), max(n, 1), seed)
    return (rows.withColumn("_p", p)
            .withColumn("shard", (F.col("_p") % shards).cast("int"))
            .withColumn("slot", F.floor(F.col("_p") / shards).cast("long")).drop("_p"))


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder per shard, files in slot order; many tasks may share a shard."""
    (assigned.repartitionByRange(shuffle_tasks(assigned.sparkSession), "shard", "slot")
     .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))


def op3_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    digest = docs.select("doc_id", (utf8_len("text") + ROW_OVERHEAD).alias("size"),
                         F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    out = assign_shards(digest, ["doc_id", "size", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "row_number")
