"""Packing of tokenised documents into sequences by length patterns.

The histogram of piece lengths (at most one bin per token of a sequence) is
fitted by non-negative least squares with all patterns of up to three lengths that
fill a sequence exactly, priced into the fit round by round; the fitted repeat counts are rounded and cut to what
the histogram holds, and the pieces that are left over are packed best fit,
longest first, on the histogram. Both give patterns with repeat counts, so the
plan is bounded by the sequence length, whatever the corpus holds.

A piece finds its place by its rank among the pieces of its length: the task
that reads it counts within its partition, partition totals give the rest, and
the plan maps (length, rank) to sequence and offset. No length, however
frequent, is gathered in one task.

Defined results: a null or empty text is the end id alone. A document of over
``SEQUENCE`` ids is cut into full pieces and a shorter last one. Rows are
packed one by one, so repeated rows and null ids are packed as they come. An
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import arrow_schema, crc32_rows, materialize, small_batches, table, text_chunks, tidy_worker
from tidewater.llm.tokens import encode_batch, vocabulary_path

SEQUENCE = 2048
END_ID = 0
ROUNDS = 60               # in which priced patterns join the fit
STEPS = 100               # of the projected gradient in a round
MIN_PRICE = 1e-6          # of the largest bin
CHUNK_BYTES = 1_500_000
PIECES = ("doc_id {id}, piece int, start long, length long, ids_crc32 long, part int, nth long")


def pieces_of(docs: DataFrame, vocabulary: str, size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece; ``nth`` counts the pieces of its length within ``part``."""
    kind = PIECES.format(id=docs.schema["doc_id"].dataType.simpleString())
    schema = arrow_schema(kind)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy_worker(keep=True)      # what earlier operators left; the encoder outlives a task
        part, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for b in batches:
            for first, texts in text_chunks(b, "text", CHUNK_BYTES):
                ids, bounds = encode_batch(vocabulary, texts, end_id)
                n = np.diff(bounds)
                cuts = -(-n // size)
                doc = np.repeat(np.arange(len(texts)), cuts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                start = piece * size
                length = np.minimum(n[doc] - start, size)
                order = np.argsort(length, kind="stable")
                run_start = np.r_[0, np.flatnonzero(np.diff(length[order])) + 1]
                sizes = np.diff(np.r_[run_start, len(order)])
                nth = np.empty(len(doc), np.int64)
                nth[order] = np.arange(len(order)) - np.repeat(run_start, sizes) + seen[length[order]]
                seen[length[order][run_start]] += sizes
                at = bounds[:-1][doc] + start
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id").slice(first, len(texts)).take(pa.array(doc)),
                    pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array(crc32_rows(ids, np.r_[at, len(ids)]), pa.int64()),
                    pa.array(np.full(len(doc), part), pa.int32()), pa.array(nth)], schema=schema)
        tidy_worker(keep=True)

    return docs.select("doc_id", "text").mapInArrow(run, kind)


def enumerate_patterns(hist: np.ndarray) -> np.ndarray:
    """All rows ``a >= b >= c`` of present lengths that sum to the sequence size (0: unused), by ``a``.

    At most a twelfth of the squared sequence size, whatever the corpus holds.
    """
    size = len(hist) - 1
    present = np.flatnonzero(hist > 0)
    has = hist > 0
    has[0] = True                 # a pattern of fewer lengths
    out = [np.zeros((0, 3), np.int64)]
    for a in present[3 * present >= size].tolist():
        b = np.flatnonzero(has[:a + 1])
        c = size - a - b
        b, c = b[(c >= 0) & (c <= b)], c[(c >= 0) & (c <= b)]
        ok = has[c]
        out.append(np.c_[np.full(ok.sum(), a), b[ok], c[ok]])
    return np.concatenate(out).astype(np.int64)


def _descend(patterns: np.ndarray, target: np.ndarray, weight: np.ndarray, x: np.ndarray, steps: int) -> np.ndarray:
    """Accelerated projected gradient from ``x``; the patterns' matrix has three entries a row and is never built."""
    def use(v: np.ndarray) -> np.ndarray:
        return np.bincount(patterns.ravel(), np.repeat(v, 3), len(target))

    def back(r: np.ndarray) -> np.ndarray:
        return (weight * r)[patterns].sum(axis=1)

    v = np.ones(len(patterns))
    for _ in range(30):
        v = back(use(v))
        v /= np.linalg.norm(v)
    step = 1 / (1.05 * np.linalg.norm(back(use(v))))
    y, t = x, 1.0
    for _ in range(steps):
        new = np.maximum(0, y - step * back(use(y) - target))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def fit_counts(hist: np.ndarray, patterns: np.ndarray, rounds: int = ROUNDS, steps: int = STEPS) -> np.ndarray:
    """Non-negative repeat counts with least squared error against the histogram; a bin's error counts by its
    length, as long pieces are hard to place later.

    Every pattern is priced by what it would take off the error. In each round the best one of
    each largest length joins the fit and those fitted to nothing leave it, until none has a price.
    """
    target = hist.astype(np.float64)
    target[0] = 0
    out = np.zeros(len(patterns))
    if not len(patterns):
        return out
    weight = np.arange(len(target)) / (len(target) - 1)
    same = patterns[:, :, None] == patterns[:, None, :]
    norm = np.sqrt((same * weight[patterns][:, :, None]).sum(axis=(1, 2)))
    group = np.flatnonzero(np.r_[True, np.diff(patterns[:, 0]) != 0])     # patterns come by their largest length
    size = np.diff(np.r_[group, len(patterns)])
    least = MIN_PRICE * target.max()
    active = np.zeros(0, np.int64)
    for _ in range(rounds):
        left = target - np.bincount(patterns[active].ravel(), np.repeat(out[active], 3), len(target))
        price = (weight * left)[patterns].sum(axis=1) / norm
        price[active] = 0
        top = np.flatnonzero(price == np.repeat(np.maximum.reduceat(price, group), size))
        best = top[np.r_[True, np.diff(patterns[top, 0]) != 0]]
        best = best[price[best] > least]
        if not len(best):
            break
        active = np.concatenate([active, best])
        x = _descend(patterns[active], target, weight, out[active], steps)
        out[active] = x
        active = active[x > 0]
    return out


def plan_patterns(hist: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeat count) that use up the histogram exactly."""
    size = len(hist) - 1
    left = hist.astype(np.int64).copy()
    left[0] = 0
    patterns = enumerate_patterns(left)
    total = np.cumsum(fit_counts(left, patterns))
    rounded = np.diff(np.r_[0, np.floor(total + 0.5)]).astype(np.int64)
    plan: list[tuple[tuple[int, ...], int]] = []
    for j in np.flatnonzero(rounded > 0).tolist():
        lengths = tuple(x for x in patterns[j].tolist() if x)
        times = min(int(rounded[j]), *[int(left[x]) // lengths.count(x) for x in lengths])
        if times > 0:
            for x in lengths:
                left[x] -= times
            plan.append((lengths, times))
    return plan + best_fit(left, size)


def best_fit(left: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, for groups of equal lengths and equal bins at once."""
    done: list[tuple[tuple[int, ...], int]] = []
    open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(room: int, lengths: tuple[int, ...], times: int) -> None:
        if room:
            open_bins.setdefault(room, []).append((lengths, times))
        else:
            done.append((lengths, times))

    for length in range(size, 0, -1):
        todo = int(left[length])
        while todo:
            room = min((r for r in open_bins if r >= length), default=0)
            if room:
                lengths, times = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                took = min(todo, times)
                put(room - length, (*lengths, length), took)
                if times > took:
                    put(room, lengths, times - took)
                todo -= took
            else:
                each = size // length
                full, some = divmod(todo, each)
                if full:
                    put(size - each * length, (length,) * each, full)
                if some:
                    put(size - some * length, (length,) * some, 1)
                todo = 0
    return done + [x for bins in open_bins.values() for x in bins]


def place_table(plan: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys ``length << 40 | first rank``, with the first sequence and the offset of each."""
    ranks: dict[int, int] = {}
    keys, seqs, offsets, seq = [], [], [], 0
    for lengths, times in plan:
        offset = 0
        for x in lengths:
            rank = ranks.get(x, 0)
            keys.append(x << 40 | rank)
            seqs.append(seq)
            offsets.append(offset)
            ranks[x] = rank + times
            offset += x
        seq += times
    order = np.argsort(np.array(keys, np.int64))
    return (np.array(keys, np.int64)[order], np.array(seqs, np.int64)[order], np.array(offsets, np.int64)[order])


def pack(docs: DataFrame, vocabulary: str, size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Pieces of ``docs`` with ``sequence_id`` and ``offset``."""
    with small_batches(docs.sparkSession):
        pieces = materialize(pieces_of(docs, vocabulary, size, end_id), "pieces")
    by_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    hist = np.zeros(size + 1, np.int64)
    for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect():   # a row per length
        hist[r["length"]] = r["n"]
    places = place_table(plan_patterns(hist))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = (pieces.join(before, ["length", "part"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank")))
    shared = docs.sparkSession.sparkContext.broadcast(places)   # bounded by the sequence size

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy_worker()               # the encoder isn't needed any more
        keys, seqs, offsets = shared.value
        for b in batches:
            if b.num_rows:
                length = b.column("length").to_numpy(zero_copy_only=False)
                want = length << 40 | b.column("rank").to_numpy(zero_copy_only=False)
                at = np.searchsorted(keys, want, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:5], pa.array(seqs[at] + want - keys[at]), pa.array(offsets[at])],
                    names=[*b.schema.names[:5], "sequence_id", "offset"])

    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema.fields[:5])
    return ranked.mapInArrow(run, f"{kind}, sequence_id long, offset long")


def op8_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary_path())
