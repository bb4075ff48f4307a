"""Benchmark decontamination by template canonicalisation.

Numbers, units after a number and names (capitalised words inside a sentence)
become typed placeholders, all other words are lower-cased. Windows of
``WINDOW`` such tokens of benchmark items and documents are hash-joined, and so
are the same windows as plain lower-cased tokens: case and line breaks decide
what becomes a placeholder, but not whether a copy is found. The
windows of a document that match an item at the same shift are an alignment.
Where one value of the item stands for two different values of the document,
its slots aren't a re-parameterisation: the alignment loses the windows that
hold that value, save those in runs of ``MIN_RUN`` verbatim windows. An item
counts as leaked when its remaining windows reach ``MIN_SHARE`` of its usable
ones, or when ``MIN_RUN`` usable windows in a row remain at one shift, so that
an excerpt of a long item counts whatever its share. Both are taken of the
windows that are usable with placeholders, and of all.

Documents' windows are tested against a bit map of fixed size that the
benchmark's hashes set, so only few leave the reading task; the join decides.

Defined results: null and empty texts have no windows. An item of fewer than
``WINDOW`` tokens is one window of its own length; windows of fewer than
``MIN_LITERALS`` words that aren't placeholders are unusable with placeholders,
those of fewer that aren't numbers also as plain tokens, and an item without
usable windows can't be found. Repeated rows get equal results; rows
are told apart by id and text hash, so ties of ids don't mix texts. Null item
ids are dropped, null document ids kept. Empty tables give an empty table.
Other columns are ignored, or passed on by ``drop_contaminated``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import Vocabulary, free_name, hash_bitmap, in_bitmap, map_batches, materialize, small_batches, table, text_chunks

WINDOW = 8
MIN_LITERALS = 3
MIN_SHARE = 0.5
MIN_RUN = 6   # windows in a row at one shift: 13 tokens where all are usable; verbatim ones always count
CHUNK_BYTES = 1_500_000
MAP_BITS = 1 << 22

# Units of measure that may follow a number
UNITS = frozenset("""
mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers
mg g kg t oz lb lbs gram grams kilogram kilograms ton tons ounce ounces pound pounds
ml l cl dl liter liters litre litres gallon gallons pint pints cup cups
s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years
mph kph k c f degree degrees percent dollar dollars euro euros cent cents
""".split())
# Symbols that may follow a number as its unit
SYMBOLS = frozenset("%€$£°")

_TOKEN = re.compile(r"[^\W\d_]+|\d+(?:[.,]\d+)*|[.!?:\n%€$£°]")
_NUM, _UNIT, _NAME = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_BASE = np.uint64(0x100000001B3)
_WORD, _NUMBER, _STOP, _SYMBOL = range(4)


def _kind(t: str) -> int:
    c = t[0]
    return _NUMBER if c.isdecimal() else _WORD if c.isalnum() else _SYMBOL if c in SYMBOLS else _STOP


def canonical(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str], np.ndarray]:
    """Tokens of all texts: document, hash, is-placeholder, raw vocabulary, vocabulary index.

    Which tokens there are depends neither on case nor on white space.
    """
    return _canonical(texts)[:5]


def _canonical(texts: list[str | None]) -> tuple:
    """As :func:`canonical`, and the hash as a plain token and is-number."""
    import xxhash

    vocab = Vocabulary()
    flat, sizes = [], []
    for t in texts:
        found = _TOKEN.findall(t or "")
        flat.append(np.fromiter(map(vocab.__getitem__, found), np.int64, len(found)))
        sizes.append(len(found))
    words = list(vocab)
    at = np.concatenate(flat) if flat else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    kinds = np.fromiter(map(_kind, words), np.int64, len(words))
    hashes = np.fromiter((xxhash.xxh64_intdigest(w.lower()) for w in words), np.uint64, len(words))
    capital = np.fromiter((len(w) > 1 and w.istitle() for w in words), bool, len(words))
    unit = np.fromiter((w.lower() in UNITS or w in SYMBOLS for w in words), bool, len(words))
    kind = kinds[at]
    first = np.r_[True, doc[1:] != doc[:-1]] if len(doc) else np.zeros(0, bool)
    before = np.r_[_STOP, kind[:-1]] if len(doc) else kind
    is_number = kind == _NUMBER
    is_unit = unit[at] & _after_number(doc, kind, at == vocab.get("\n", -1))
    is_name = (kind == _WORD) & capital[at] & (before != _STOP) & ~first & ~is_unit
    keep = (kind == _WORD) | is_number | is_unit
    plain = hashes[at]
    code = plain.copy()
    code[is_number], code[is_unit], code[is_name] = _NUM, _UNIT, _NAME
    slot = is_number | is_unit | is_name
    return doc[keep], code[keep], slot[keep], words, at[keep], plain[keep], is_number[keep]


def _after_number(doc: np.ndarray, kind: np.ndarray, is_break: np.ndarray) -> np.ndarray:
    """Whether the token before, line breaks aside, is a number of the same text."""
    if not len(doc):
        return np.zeros(0, bool)
    text = np.maximum.accumulate(np.where(is_break, -1, np.arange(len(doc))))
    last = np.r_[-1, text[:-1]]
    return (last >= 0) & (kind[last] == _NUMBER) & (doc[last] == doc)


def windows(doc: np.ndarray, code: np.ndarray, slot: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the usable windows of ``size`` tokens, and their hashes."""
    n = len(code) - size + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.full(n, size, np.uint64)
    for i in range(size):
        h = h * _BASE + code[i:i + n]
        h ^= h >> np.uint64(29)
    slots = np.r_[0, np.cumsum(slot)]
    ok = (doc[:n] == doc[size - 1:]) & (size - (slots[size:] - slots[:n]) >= min(MIN_LITERALS, size))
    start = np.flatnonzero(ok)
    return start, h[start]


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def item_windows(items: DataFrame) -> DataFrame:
    """(hash, item_id, at, nth, n_windows, nth_typed, n_typed, size, plain, slots) of every usable window of an item.

    The window is the ``nth`` of ``n_windows``, and the ``nth_typed`` of
    ``n_typed`` that are usable with placeholders, or null. One with
    placeholders has two rows, one of them ``plain``; one without is plain.
    """
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        ids = batch.column("item_id").to_pylist()
        for item, text in zip(ids, batch.column("text").to_pylist()):
            doc, code, slot, words, at, plain, number = _canonical([text])
            size = min(WINDOW, len(code))
            if size < MIN_LITERALS:
                continue
            start, h = windows(doc, plain, number, size)
            typed, typed_h = windows(doc, code, slot, size)     # all of them are in start
            if not len(start):
                continue
            own = np.searchsorted(typed, start)
            held = np.isin(start, typed)
            nth_typed = [int(k) if x else None for k, x in zip(own, held)]
            two = np.flatnonzero(np.isin(typed, start[_has(slot, start, size)]))
            nth = np.searchsorted(start, typed[two])
            n, every = len(start) + len(two), np.r_[start, typed[two]]
            yield {"hash": _signed(np.r_[h, typed_h[two]]), "item_id": [item] * n, "at": every,
                   "nth": np.r_[np.arange(len(start)), nth], "n_windows": [len(start)] * n,
                   "nth_typed": nth_typed + two.tolist(), "n_typed": [len(typed)] * n, "size": [size] * n,
                   "plain": [True] * len(start) + [False] * len(two), "slots": _slots(every, size, slot, words, at)}

    return map_batches(items.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL"), run,
                       f"hash long, item_id {kind}, at long, nth long, n_windows long, nth_typed long, n_typed long, size int, "
                       "plain boolean, slots array<string>")


def _has(slot: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """Whether the windows from ``start`` hold a placeholder."""
    slots = np.r_[0, np.cumsum(slot)]
    return slots[start + size] > slots[start]


def _slots(start: np.ndarray, size: int, slot: np.ndarray, words: list[str], at: np.ndarray) -> list[list[str]]:
    return [[words[at[i]].lower() for i in range(s, s + size) if slot[i]] for s in start.tolist()]


def document_windows(docs: DataFrame, sizes: list[int], bits: np.ndarray) -> DataFrame:
    """(doc_id, text_hash, hash, at, slots) of the windows, in both forms, whose bit is set."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        for first, texts in text_chunks(batch, "text", CHUNK_BYTES):
            doc, code, slot, words, at, plain, number = _canonical(texts)
            before = np.searchsorted(doc, np.arange(len(texts)))
            for size in sizes:
                start, h = windows(doc, plain, number, size)
                typed, typed_h = windows(doc, code, slot, size)
                two = _has(slot, typed, size)      # without a placeholder both forms are the same
                start, h = np.r_[start, typed[two]], np.r_[h, typed_h[two]]
                hit = np.flatnonzero(in_bitmap(bits, _signed(h)))
                if len(hit):
                    start, h = start[hit], h[hit]
                    row = pa.array(first + doc[start])
                    yield {"doc_id": batch.column("doc_id").take(row), "text_hash": batch.column("text_hash").take(row),
                           "hash": _signed(h), "at": start - before[doc[start]],
                           "slots": _slots(start, size, slot, words, at)}

    slim = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("string").alias("text"))
    return map_batches(slim, run, f"doc_id {kind}, text_hash long, hash long, at long, slots array<string>")


def _runs(df: DataFrame, key: list[str], nth: str, name: str) -> DataFrame:
    """``df`` with the number of rows of its alignment that follow each other by ``nth`` around each row."""
    island = df.withColumn("_island", F.col(nth) - F.row_number().over(Window.partitionBy(*key).orderBy(nth)))
    count = F.count("*").over(Window.partitionBy(*key, "_island"))
    return island.withColumn(name, F.when(F.col(nth).isNotNull(), count)).drop("_island")


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, n_windows, share, changed) for every leaked item of a document."""
    bench = materialize(item_windows(items), "items")
    sizes = sorted(r["size"] for r in bench.select("size").distinct().collect())   # at most WINDOW of them
    bits = hash_bitmap(bench, "hash", MAP_BITS)
    d = document_windows(docs, sizes, bits)
    b = bench.select("hash", "item_id", F.col("at").alias("item_at"), "nth", "n_windows", "nth_typed", "n_typed", "plain",
                     F.col("slots").alias("item_slots"))
    slots = F.when(F.col("plain"), F.col("item_slots")).otherwise(F.col("slots"))   # equal tokens have equal slots
    found = (d.join(b, "hash").withColumn("slots", slots).where(F.size("slots") == F.size("item_slots"))
             .select("doc_id", "text_hash", "item_id", (F.col("at") - F.col("item_at")).alias("shift"), "item_at", "nth", "n_windows",
                     "nth_typed", "n_typed", "plain", F.arrays_zip("item_slots", "slots").alias("pairs")))
    with small_batches(docs.sparkSession):      # whole texts go to Python
        matched = materialize(found, "matched")
    key = ["doc_id", "text_hash", "item_id", "shift"]
    torn = (matched.where("NOT plain").select(*key, F.explode("pairs").alias("p"))
            .groupBy(*key, F.col("p.item_slots").alias("value")).agg(F.min("p.slots").alias("lo"), F.max("p.slots").alias("hi"))
            .where("lo <> hi").groupBy(*key).agg(F.collect_list("value").alias("torn")))   # values of one item
    t = torn.select(*[F.col(c).alias(f"t_{c}") for c in key], "torn")
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"t_{c}"))
    held = F.coalesce(F.arrays_overlap(F.col("pairs.item_slots"), F.col("torn")), F.lit(False))
    each = (matched.join(t, same, "left").withColumn("held", held)
            .withColumn("changed", F.exists("pairs", lambda p: p["item_slots"] != p["slots"]))
            .groupBy(*key, "item_at", "nth", "n_windows", "nth_typed", "n_typed")
            .agg(F.max("changed").alias("changed"), F.max("held").alias("held"))
            .withColumn("nth_verbatim", F.when(~F.col("changed"), F.col("nth"))))
    kept = (_runs(each, key, "nth_verbatim", "verbatim")
            .where(~F.col("held") | F.coalesce(F.col("verbatim") >= MIN_RUN, F.lit(False))))
    kept = _runs(_runs(kept, key, "nth", "run"), key, "nth_typed", "typed_run")
    typed = F.countDistinct(F.when(F.col("nth_typed").isNotNull(), F.col("item_at")))
    every = F.countDistinct("item_at")
    share = F.greatest(F.try_divide(typed, F.max("n_typed")), every / F.max("n_windows"))
    return (kept.groupBy("doc_id", "text_hash", "item_id")
            .agg(every.alias("n_windows"), share.alias("share"), F.greatest(F.max("run"), F.max("typed_run")).alias("run"),
                 F.max("changed").alias("changed"))
            .where((F.col("share") >= MIN_SHARE) | (F.col("run") >= MIN_RUN))
            .select("doc_id", "text_hash", "item_id", "n_windows", "changed", "share"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a leaked item."""
    one, two = free_name(docs, "leak_id"), free_name(docs, "leak_hash")
    found = materialize(leaks(docs, items).select(F.col("doc_id").alias(one), F.col("text_hash").alias(two)).distinct(), "leaks")
    return docs.join(found, docs["doc_id"].eqNullSafe(F.col(one)) & (F.xxhash64(docs["text"]) == F.col(two)), "left_anti")


def op6_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents with the items that they hold."""
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return (found.groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"),
                                        F.sum("n_windows").alias("n_windows"), F.max("share").alias("share"),
                                        F.max("changed").alias("reparameterised")))
