"""Spelling variants: words one edit apart, found through Bloom filters.

1. Words: the letter runs of every whole text, counted per record batch and
   then by Spark; the vocabulary is a table.
2. The vocabulary's words go into blocked Bloom filters, one for each word
   length: a word sets ``PROBES`` bits of one 512-bit block. Spark builds the
   blocks; their number follows the vocabulary, exactly counted, and what is
   broadcast at a time is bounded by ``MAX_FILTER_BYTES``. A vocabulary that
   needs more is dealt by hash into rounds, each with its own filters.
3. Tasks make the edits of every word and probe them. A word's hash is a
   polynomial over its code points, so an edit's hash follows from prefix sums
   without writing the edit down. Of two near words one side is enough: the
   longer word loses a code point, or a code point is replaced by a larger one.
4. Only edits that a filter lets through become strings and are shuffled to an
   exact join with the vocabulary, which removes the false ones.

Then every word takes its near word of largest count (ties: smallest) as its
form, where that counts twice as much, and forms are followed to the last one
by pointer doubling: counts double at every step, so chains are short.

A null text has no words. A null id counts as an empty one in the hash that
plants misspellings. Repeated rows count again. An empty table gives no rows.
Texts are counted whole; longer ones are worked on by themselves. Extra columns
are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import map_batches, materialize, table, text_chunks
from tidewater.session import remove_path, scratch_path

MIN_LENGTH = 5            # code points of a word
MIN_COUNT = 3             # occurrences of a word
TYPO_EVERY = 97           # a run loses a code point where this divides its hash
FORM_RATIO = 2            # a form counts at least so many times its word's count
# code points U+00C0 to U+00FF are C3 80 to C3 BF in UTF-8
RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")
LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]

BLOCK_WORDS = 8           # 64-bit words of a block
BITS_PER_WORD = 16        # of filter for each word of the vocabulary
PROBES = 6                # bits that a word sets in its block
MAX_FILTER_BYTES = 32 << 20
LONGEST_SHARD = 40        # words of this length or longer share a filter
CHUNK_BYTES = 8 << 20     # text that a task counts at a time
EDIT_CELLS = 1 << 21      # edits that a task probes at a time


# -- 1: words ---------------------------------------------------------------

def planted(doc_id: int | None, run: bytes) -> bytes:
    """The lower-cased run, or what is left of it where its hash plants a misspelling."""
    h = zlib.crc32(run, zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode())))
    if h % TYPO_EVERY:
        return run
    word = run.decode()
    at = h % len(word)
    return (word[:at] + word[at + 1:]).encode()


def _count(batch: pa.RecordBatch) -> Iterator[dict]:
    ids = batch.column("doc_id")
    for first, texts in text_chunks(batch, "text", CHUNK_BYTES):
        total: Counter = Counter()
        for doc_id, text in zip(ids.slice(first, len(texts)).to_pylist(), texts):
            if not text:
                continue
            start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
            for run, n in Counter(RUN.findall(text.encode().lower())).items():
                if zlib.crc32(run, start) % TYPO_EVERY == 0:
                    run = planted(doc_id, run)
                total[run] += n
        # a word's code points are its bytes less the second bytes of pairs
        kept = {w: n for w, n in total.items() if len(w) - w.count(b"\xc3") >= MIN_LENGTH}
        yield {"word": [w.decode() for w in kept], "n": list(kept.values())}


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): the distinct words of all documents with their counts."""
    counts = map_batches(docs.select("doc_id", "text"), _count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


# -- 2: filters -------------------------------------------------------------

# fixed at random: a value for every code point, and an odd base for its place
_RANDOM = np.random.default_rng(12)
VALUES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
BASE = int(_RANDOM.integers(1 << 40, 1 << 62)) | 1
_MASK = (1 << 64) - 1


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spread the polynomial's bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out, p = np.empty(n, np.uint64), 1
    for i in range(n):
        out[i], p = p, p * BASE & _MASK
    return out


def _points(words: list[str]) -> np.ndarray:
    """Code points (all below 256) of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def word_hashes(points: np.ndarray) -> np.ndarray:
    terms = VALUES[points] * _powers(points.shape[1])
    return terms.sum(1, dtype=np.uint64)


def _by_length(words: list[str]) -> dict[int, np.ndarray]:
    """{length: places of the words of that length}."""
    sizes = np.array([len(w) for w in words])
    return {int(n): np.flatnonzero(sizes == n) for n in np.unique(sizes)}


def _shard(length: int) -> int:
    return min(length, LONGEST_SHARD)


def _bits(mixed: np.ndarray, k: int) -> np.ndarray:
    """The k-th bit (0 to 511) of each word in its block: nine bits of the hash each."""
    return mixed >> np.uint64(9 * k) & np.uint64(511)


def _second(h: np.ndarray) -> np.ndarray:
    """Another hash of the same word, for the block and the round."""
    return _mixed(h ^ np.uint64(0x9E3779B97F4A7C15))


def _rounds_of(second: np.ndarray, rounds: int) -> np.ndarray:
    return (second >> np.uint64(40)) % np.uint64(rounds)


def _set_bits(blocks: dict[int, int], rounds: int):
    """Tasks turn words into (round, shard, block, eight 64-bit words with their bits)."""
    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        words = batch.column("word").to_pylist()
        for n, at in _by_length(words).items():
            h = word_hashes(_points([words[i] for i in at]))
            mixed, second = _mixed(h), _second(h)
            block = (second & np.uint64(0xFFFFFFFF)) % np.uint64(blocks[_shard(n)])
            bits = np.zeros((len(at), BLOCK_WORDS), np.uint64)
            rows = np.arange(len(at))
            for k in range(PROBES):
                b = _bits(mixed, k)
                bits[rows, b >> np.uint64(6)] |= np.uint64(1) << (b & np.uint64(63))
            yield {"round": _rounds_of(second, rounds).astype(np.int32),
                   "shard": np.full(len(at), _shard(n), np.int32), "block": block.astype(np.int64),
                   **{f"w{i}": bits[:, i].view(np.int64) for i in range(BLOCK_WORDS)}}

    return run


class Filters:
    """The blocked filters of one round: for each shard of lengths an array of blocks."""

    def __init__(self, blocks: dict[int, int], rounds: int, this: int) -> None:
        self.rounds, self.round = rounds, this
        self.bits = {s: np.zeros((n, BLOCK_WORDS), np.uint64) for s, n in blocks.items()}

    def may_hold(self, length: int, h: np.ndarray) -> np.ndarray:
        """Which of the hashes may be words of this length; others surely are not."""
        out = np.zeros(h.shape, bool)
        bits = self.bits.get(_shard(length))
        if bits is None or not h.size:
            return out
        second = _second(h)
        here = np.flatnonzero(_rounds_of(second, self.rounds) == self.round) if self.rounds > 1 else np.arange(h.size)
        block = ((second[here] & np.uint64(0xFFFFFFFF)) % np.uint64(len(bits))).astype(np.int64)
        mixed = _mixed(h[here])
        for k in range(PROBES):
            b = _bits(mixed, k)
            hit = bits[block, (b >> np.uint64(6)).astype(np.int64)] >> (b & np.uint64(63)) & np.uint64(1) != 0
            here, block, mixed = here[hit], block[hit], mixed[hit]
        out[here] = True
        return out


def filter_plan(words: DataFrame, max_bytes: int = MAX_FILTER_BYTES) -> tuple[dict[int, int], int]:
    """Blocks of each shard in one round, and how many rounds keep within ``max_bytes``."""
    shard = F.least(F.length("word"), F.lit(LONGEST_SHARD)).alias("shard")
    sizes = {r["shard"]: r["count"] for r in words.groupBy(shard).count().collect()}  # at most LONGEST_SHARD rows
    need = {s: ceil(n * BITS_PER_WORD / 512) for s, n in sizes.items()}
    rounds = max(1, ceil(sum(need.values()) * 64 / max_bytes))
    return {s: ceil(n / rounds) for s, n in need.items()}, rounds


def build_filters(words: DataFrame, max_bytes: int = MAX_FILTER_BYTES) -> Iterator[Filters]:
    """The filters of each round; the driver holds one round's at a time."""
    blocks, rounds = filter_plan(words, max_bytes)
    cols = [f"w{i}" for i in range(BLOCK_WORDS)]
    schema = "round int, shard int, block long, " + ", ".join(f"{c} long" for c in cols)
    rows = map_batches(words.select("word"), _set_bits(blocks, rounds), schema)
    for this in range(rounds):
        out = Filters(blocks, rounds, this)
        # at most one row per block: MAX_FILTER_BYTES and a bound on shards that are rounded up
        found = (rows.filter(F.col("round") == this).groupBy("shard", "block")
                 .agg(*[F.bit_or(c).alias(c) for c in cols]).toArrow())
        shard, block = found.column("shard").to_numpy(), found.column("block").to_numpy()
        bits = np.stack([found.column(c).to_numpy() for c in cols], 1).view(np.uint64) if len(shard) else None
        for s in out.bits:
            at = np.flatnonzero(shard == s)
            if len(at):
                out.bits[s][block[at]] = bits[at]
        yield out


# -- 3: edits ---------------------------------------------------------------

def _deletions(points: np.ndarray, filters: Filters) -> tuple[np.ndarray, list[str]]:
    """(row, shorter word) of the deletions that the filters let through."""
    rows, n = points.shape
    power = _powers(n)
    terms = VALUES[points] * power
    before = np.cumsum(terms, 1, dtype=np.uint64) - terms
    down = np.uint64(pow(BASE, -1, 1 << 64))
    after = (terms.sum(1, dtype=np.uint64)[:, None] - before - terms) * down
    # one of a run of equal code points stands for all of them
    new = np.ones(points.shape, bool)
    new[:, 1:] = points[:, 1:] != points[:, :-1]
    row, at = np.nonzero(new)
    hit = filters.may_hold(n - 1, (before + after)[row, at])
    row, at = row[hit], at[hit]
    texts = [bytes(points[r]).decode("latin-1") for r in row]
    return row, [t[:i] + t[i + 1:] for t, i in zip(texts, at.tolist())]


def _replacements(points: np.ndarray, filters: Filters) -> tuple[np.ndarray, list[str]]:
    """(row, word) of the replacements by a larger code point that the filters let through."""
    n = points.shape[1]
    power, letters = _powers(n), np.array(LETTERS, np.uint8)
    whole = word_hashes(points)
    rows, ats, news = [], [], []
    for i in range(n):
        old = points[:, i]
        row, k = np.nonzero(letters[None, :] > old[:, None])
        h = whole[row] + (VALUES[letters[k]] - VALUES[old[row]]) * power[i]
        hit = filters.may_hold(n, h)
        rows.append(row[hit])
        news.append(letters[k[hit]])
        ats.append(np.full(int(hit.sum()), i))
    row, at, new = np.concatenate(rows), np.concatenate(ats), np.concatenate(news)
    texts = [bytes(points[r]).decode("latin-1") for r in row]
    return row, [t[:i] + chr(c) + t[i + 1:] for t, i, c in zip(texts, at.tolist(), new.tolist())]


def _probe(filters):
    """Tasks turn words into (word, n, other) for every edit that may be a word."""
    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        known = filters.value
        words, counts = batch.column("word").to_pylist(), batch.column("n").to_numpy()
        for n, at in _by_length(words).items():
            step = max(1, EDIT_CELLS // (n * len(LETTERS)))
            for a in range(0, len(at), step):
                part = at[a:a + step]
                points = _points([words[i] for i in part])
                for find in (_deletions, _replacements):
                    row, other = find(points, known)
                    yield {"word": [words[part[r]] for r in row], "n": counts[part[row]], "other": other}

    return run


def near_pairs(words: DataFrame, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """(word, n, other, other_n): every two words one edit apart, once.

    Each round of filters adds its candidates to one table; the exact join
    reads them all.
    """
    spark = words.sparkSession
    path = scratch_path(spark, "llm", "edits")
    schema = "word string, n long, other string"
    spark.createDataFrame([], schema).write.parquet(path)
    for filters in build_filters(words, max_filter_bytes):
        shared = spark.sparkContext.broadcast(filters)
        map_batches(words, _probe(shared), schema).write.mode("append").parquet(path)
        shared.unpersist()
    maybe = spark.read.schema(schema).parquet(path)
    known = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = materialize(maybe.join(known, "other").select("word", "n", "other", "other_n"), "near")
    remove_path(spark, path)
    return pairs


# -- 4: forms and roots -----------------------------------------------------

def forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n) of all words."""
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"),
                                          F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    enough: Column = -F.col("best.less") >= FORM_RATIO * F.col("n")
    return (words.join(best, "word", "left")
            .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                    F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")))


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form.

    Every round replaces a word's goal by its goal's goal, so a chain of L forms
    takes log2(L) rounds; a goal without a form is a root.
    """
    at = materialize(formed.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("goal")), "goals")
    while True:
        onward = at.select(F.col("word").alias("goal"), F.col("goal").alias("further"))
        moved = at.join(onward, "goal", "left").select(
            "word", F.coalesce("further", "goal").alias("goal"), F.col("further").isNotNull().alias("moved"))
        moved = materialize(moved, "goals")
        at = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return at.withColumnRenamed("goal", "root")


def spelling_groups(docs: DataFrame, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words of ``docs``."""
    words = materialize(vocabulary(docs), "vocabulary")
    formed = materialize(forms(words, near_pairs(words, max_filter_bytes)), "forms")
    return (formed.join(roots(formed), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"))
