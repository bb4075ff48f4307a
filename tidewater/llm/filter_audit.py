"""Filter interaction audit: what each filter removes, in all 120 orders of five filters.

A document's mask says which filters it fails. In the order with lexicographic
rank r it is removed at the step of the first letter that its mask holds. The
orders that start with the same letters have neighbouring ranks, so a mask is
removed at step s by filter f exactly in the intervals of ranks whose prefix is
s - 1 letters outside the mask and then f. A mask's count is added where such
an interval starts and taken off where it ends (Lehmer digits give both ends);
the running sum over the 120 ranks is then the number of documents that a step
of an order removes. Documents are counted once, per part and mask; the orders
are never applied to documents.

Rows: a null text counts as empty, a null ``lang`` as the part ''. Repeated rows
count as often as they occur; equal ids are not smaller than one another, so
copies of one row don't fail the copy filter because of each other. A null id is
neither smaller nor larger than any other: such a row fails the copy filter
never, and no row fails because of it. A document with several label rows is
good (toxic) if one of them says so; null labels say nothing. An empty table
gives no rows. Texts are counted whole, whatever their length. Extra columns
of both tables are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import materialize, table

FILTERS = "ABCDE"
ORDERS = factorial(len(FILTERS))
COPY_BIT = 1 << FILTERS.index("E")
# thresholds of the filters
MIN_WORDS = 100
MIN_DISTINCT_PCT = 80
MAX_UPPER_PCT = 10
SYMBOLS = r"[#$%&*|]"
WHITE_SPACE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

COUNTS = ("n", "good", "toxic")


def lehmer_rank(prefix: str, letters: str = FILTERS) -> int:
    """Lexicographic rank of the first permutation of ``letters`` that starts with ``prefix``."""
    left, rank = sorted(letters), 0
    for c in prefix:
        rank += left.index(c) * factorial(len(left) - 1)
        left.remove(c)
    return rank


def mask_intervals(letters: str = FILTERS) -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank after the last) of every removal of every mask."""
    out = []
    for mask in range(1 << len(letters)):
        failed = {c for i, c in enumerate(letters) if mask >> i & 1}
        passed = [c for c in letters if c not in failed]
        for step in range(1, len(letters) + 1):
            for before in permutations(passed, step - 1):
                for c in sorted(failed):
                    first = lehmer_rank("".join(before) + c, letters)
                    out.append((mask, step, first, first + factorial(len(letters) - step)))
    return out


def text_mask(text: Column) -> Column:
    """Which of the filters A to D the text fails, as bits."""
    words = F.filter(F.split(text, WHITE_SPACE), lambda w: w != "")
    n = F.size(words)
    failed = {
        "A": n < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PCT * n,
        "C": 100 * (F.length(text) - F.length(F.translate(text, UPPER, ""))) > MAX_UPPER_PCT * F.length(text),
        "D": text.rlike(SYMBOLS),
    }
    bits = [F.when(c, F.lit(1 << FILTERS.index(k))).otherwise(F.lit(0)) for k, c in failed.items()]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def _labelled(labels: DataFrame) -> DataFrame:
    return (labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id")
            .agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
                 F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents, good and toxic ones, per ``part`` and ``mask`` (all five bits).

    The text is read once; what is written and exchanged of a document is its
    id, part, digest and mask. Copies are found by the smallest id of each
    digest, combined map-side, and that id joins its own row only, so a text
    that fills a third of the table meets in no task. Rows without an id join
    nothing.
    """
    text = F.coalesce("text", F.lit(""))
    seen = materialize(docs.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"), text_mask(text).alias("mask")), "audit")
    known = seen.filter(F.col("doc_id").isNotNull())
    firsts = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    known = (known.join(firsts, ["digest", "doc_id"], "left").join(_labelled(labels), "doc_id", "left")
             .withColumn("mask", F.col("mask").bitwiseOR(F.when(F.col("is_first"), 0).otherwise(COPY_BIT))))
    nameless = (seen.filter(F.col("doc_id").isNull())
                .withColumns({"good": F.lit(None).cast("int"), "toxic": F.lit(None).cast("int")}))
    return (known.select("part", "mask", "good", "toxic").unionByName(nameless.select("part", "mask", "good", "toxic"))
            .groupBy("part", "mask")
            .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
                 F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")))


def audit(counts: DataFrame) -> DataFrame:
    """One row per part, order and step, from :func:`mask_counts`.

    What is joined with the counts is fixed by the filters (32 masks, 120
    orders), and a window holds the ranks, steps or orders of one part.
    """
    spark = counts.sparkSession
    counts = materialize(counts, "masks")
    intervals = spark.createDataFrame(mask_intervals(), "mask int, step int, first int, after int")
    ends = F.array(F.struct(F.col("first").alias("rank"), F.lit(1).alias("sign")),
                   F.struct(F.col("after").alias("rank"), F.lit(-1).alias("sign")))
    # the end of the last interval lies behind all ranks: nothing is left to take it off from
    changes = (counts.join(F.broadcast(intervals), "mask").select("part", "step", F.inline(ends), *COUNTS)
               .groupBy("part", "step", "rank").agg(*[F.sum(F.col("sign") * F.col(c)).alias(c) for c in COUNTS]))

    orders = spark.createDataFrame(
        [(r, s, "".join(p), p[s - 1], 1 << FILTERS.index(p[s - 1]))
         for r, p in enumerate(permutations(FILTERS)) for s in range(1, len(FILTERS) + 1)],
        "rank int, step int, filter_order string, filter string, bit int")
    parts = (counts.groupBy("part").agg(F.sum("n").alias("docs"))
             .select("part", "docs", F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("rank"))
             .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step")))
    failed = F.array(*[F.struct(F.lit(c).alias("filter"), F.lit(1 << i).alias("bit")) for i, c in enumerate(FILTERS)])
    per_filter = (counts.select("part", "mask", "n", F.inline(failed))
                  .filter(F.col("mask").bitwiseAND(F.col("bit")) != 0).groupBy("part", "filter")
                  .agg(F.sum("n").alias("failing"),
                       F.sum(F.when(F.col("mask") == F.col("bit"), F.col("n")).otherwise(0)).alias("unique_fails")))

    along_ranks = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    along_steps = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    total = lambda c: F.sum(F.coalesce(c, F.lit(0))).over(along_ranks)
    rows = (parts.join(changes, ["part", "step", "rank"], "left")
            .withColumns({"removed": total("n"), "good_lost": total("good"), "toxic_lost": total("toxic")})
            .join(F.broadcast(orders), ["rank", "step"]).join(per_filter, ["part", "filter"], "left")
            .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("failing", "unique_fails")}))
    return (rows.withColumns({"kept": F.col("docs") - F.sum("removed").over(along_steps),
                              "redundant": F.col("failing") - F.col("removed"),
                              "shapley": F.sum("removed").over(Window.partitionBy("part", "filter"))})
            .select("part", "filter_order", "step", "filter",
                    *[F.col(c).cast("long").alias(c) for c in ("kept", "removed", "redundant", "unique_fails",
                                                               "good_lost", "toxic_lost", "shapley")]))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(mask_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
