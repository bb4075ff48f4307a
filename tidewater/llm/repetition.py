"""Quality rules on repetition, from the suffix array of every text.

Words are maximal runs of bytes other than the six ASCII white-space bytes.
The suffixes of a text's word sequence are sorted by prefix doubling; the
longest common prefix of neighbours in that order gives, for each word
position, the longest substring that starts there and occurs again in the
text. Left-extensible repeats lie inside longer ones, so the union of these
spans is the union of the maximal repeated substrings.

Rules: a text is rejected when the words under repeats of at least
``MIN_REPEAT`` words exceed ``MAX_COVERED`` of all words, or when its longest
repeated substring exceeds ``MAX_LONGEST`` words.

Defined results: a null text has no words, lines or symbols; an empty text has
none either, so both fail the base rule of ten words. Rows are judged one by
one, so repeated rows and ties of ids get equal results; a null id is kept as
null. An empty table gives an empty table. Other columns of the input are
ignored by ``quality_metrics`` and passed on untouched by ``quality_filter``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import Vocabulary, map_batches, table, text_chunks, tidy_worker

MIN_WORDS = 10            # fewer words: rejected by the base rule
WINDOW = 5                # words in a window of the base repetition rule
MAX_REPEAT_PERCENT = 20   # words in repeated windows, percent of all words
MIN_REPEAT = 8            # words: shorter repeats don't count as covered
MAX_COVERED = 0.2         # covered fraction
MAX_LONGEST = 64          # words in the longest repeat
CHUNK_BYTES = 6_000_000   # bytes of text whose suffixes are sorted at once
FILTER_BYTES = 1 << 20   # text that the filter measures at a time

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"

METRICS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, n_covered_words long, n_maximal_repeats long, longest_repeat long, kept boolean")


def longest_repeats(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each position the length of its longest repeat inside its document.

    ``words`` holds word ids of all documents one after another and ``ends``,
    per position, the end of its document. A repeat is a run of words from
    that position on that also starts at another position of the document.
    """
    n = len(words)
    longest = np.zeros(n, np.int64)
    if n < 2:
        return longest
    # first order: document, then word; a rank is the place of its group's first member
    key = ends.astype(np.int64) * (int(words.max()) + 1) + words
    order = np.argsort(key, kind="stable")
    fresh = np.r_[True, np.diff(key[order]) != 0]
    place = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = place
    ranks = [rank]
    alone = fresh & np.r_[fresh[1:], True]
    active, h = order[~alone], 1
    while len(active):
        rank = ranks[-1]
        ahead = active + h
        inside = ahead < ends[active]
        second = np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, 0)
        first = rank[active]
        by = np.argsort(first * (n + 1) + second, kind="stable")
        active, first, second = active[by], first[by], second[by]
        old = np.r_[True, first[1:] != first[:-1]]
        new = old | np.r_[True, second[1:] != second[:-1]]
        at = np.arange(len(active))
        place = first + at - np.maximum.accumulate(np.where(old, at, 0))
        start = np.maximum.accumulate(np.where(new, place, 0))
        # neighbours parted in this round share h words and a bit of the next h
        parted = np.flatnonzero(new & ~old)
        if len(parted):
            i, j = active[parted - 1], active[parted]
            shared = np.full(len(parted), h, np.int64)
            for level in range(len(ranks) - 2, -1, -1):
                a, b, r = i + shared, j + shared, ranks[level]
                same = (a < ends[i]) & (b < ends[j])
                same &= r[np.minimum(a, n - 1)] == r[np.minimum(b, n - 1)]
                shared += same * (1 << level)
            np.maximum.at(longest, i, shared)
            np.maximum.at(longest, j, shared)
        rank = rank.copy()
        rank[active] = start
        ranks.append(rank)
        alone = new & np.r_[new[1:], True]
        active, h = active[~alone], h * 2
    return longest


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Which positions lie under a repeat of at least ``least`` words."""
    at = np.arange(len(longest))
    return np.maximum.accumulate(np.where(longest >= least, at + longest, 0)) > at


def measure(texts: list[str | None]) -> dict[str, list]:
    """Metrics of each text, by the suffix order of all of them at once."""
    ids = Vocabulary()
    out: dict[str, list] = {"n_words": [], "word_chars": [], "n_symbols": [], "n_dup_lines": []}
    flat: list[np.ndarray] = []
    for text in texts:
        text = text or ""
        raw = text.encode()
        words = raw.split()
        flat.append(np.fromiter(map(ids.__getitem__, words), np.int64, len(words)))
        lines = [x for x in raw.split(b"\n") if x.strip()]
        out["n_words"].append(len(words))
        out["word_chars"].append(len(text) - (len(raw) - len(raw.translate(None, _SPACE))))
        out["n_symbols"].append(len(raw) - len(raw.translate(None, _SYMBOLS)))
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
    sizes = np.array(out["n_words"], np.int64)
    bounds = np.r_[0, np.cumsum(sizes)]
    longest = longest_repeats(np.concatenate(flat) if flat else np.zeros(0, np.int64), np.repeat(bounds[1:], sizes))

    def per_doc(x: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(x)]
        return total[bounds[1:]] - total[bounds[:-1]]

    repeat_words = per_doc(covered(longest, WINDOW))
    under = per_doc(covered(longest, MIN_REPEAT))
    left = np.r_[0, longest[:-1]] if len(longest) else longest
    left[bounds[:-1][sizes > 0]] = 0
    maximal = per_doc((longest >= MIN_REPEAT) & (left <= longest))
    most = np.zeros(len(sizes), np.int64)
    if len(longest):
        most[sizes > 0] = np.maximum.reduceat(longest, bounds[:-1][sizes > 0])
    base = (sizes < MIN_WORDS) | (100 * repeat_words > MAX_REPEAT_PERCENT * sizes)
    kept = ~base & (under <= MAX_COVERED * sizes) & (most <= MAX_LONGEST)
    return out | {"n_repeat_words": repeat_words, "base_failed": base, "n_covered_words": under,
                  "n_maximal_repeats": maximal, "longest_repeat": most, "kept": kept}


def quality_metrics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its id and the metrics and verdict of its text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        for first, texts in text_chunks(batch, "text", CHUNK_BYTES):
            yield {"id": batch.column("id").slice(first, len(texts)), **measure(texts)}

    slim = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return map_batches(slim, run, f"id {kind}, {METRICS}").withColumnRenamed("id", id_col)


def quality_filter(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    Only the text goes to Python; the rows stay where they are."""

    @F.arrow_udf("boolean")
    def keeps(text: pa.Array) -> pa.Array:
        tidy_worker()
        batch = pa.RecordBatch.from_arrays([text], ["text"])
        kept = [measure(texts)["kept"] for _, texts in text_chunks(batch, "text", FILTER_BYTES)]
        return pa.array(np.concatenate(kept) if kept else np.zeros(0, bool))

    return docs.where(keeps(docs[text_col].cast("string")))


def op7_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_metrics(table(spark, sf_dir, "documents"))
