"""Token ids in patched frame-of-reference blocks.

A segment holds the ids of whole documents. Its payload, little-endian:

    magic ``PFR1``, ids u64, blocks u32, data start of each block u32, data

A block holds ``BLOCK`` ids (the last one is filled up with its own minimum):
minimum u32, width u8, exceptions u8, the ids less the minimum packed at that
width into 64-bit words, then the places (u8) and the values (u32) of the
exceptions. The width is that of the block's ``PERCENTILE`` value; larger ones
are exceptions and packed as 0. The block starts let a reader decode any range
of ids without what lies before.

``write_tokens`` range-partitions documents by id, encodes them and writes a
table of segments in ascending id order; ``read_tokens`` decodes them.

Defined results: a null or empty text has the end id alone. Null ids come
first; ties go by text hash, and repeated rows are documents of their own. A
text longer than a segment makes a larger segment. An empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import arrow_schema, crc32_rows, map_batches, shuffle_tasks, table, text_chunks
from tidewater.llm.tokens import encode_batch, vocabulary_path
from tidewater.session import scratch_path

BLOCK = 128
PERCENTILE = 90
END_ID = 1
SEGMENT_BYTES = 3_000_000   # bytes of text in a segment
MAGIC = b"PFR1"
_HEAD = 6                   # bytes before a block's packed ids
SEGMENT = "part int, seq int, part_start long, n_ids long, doc_ids array<long>, sizes array<long>, payload binary"


def _bits(x: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.where(x > 0, np.frexp(x.astype(np.float64))[1], 0).astype(np.int64)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``BLOCK`` values as rows of bytes."""
    cols = np.ascontiguousarray(values.T).astype(np.uint64)
    words = np.zeros((2 * width, values.shape[0]), np.uint64)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        words[word] |= cols[i] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= cols[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).astype("<u8").view(np.uint8)


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    words = np.ascontiguousarray(np.ascontiguousarray(packed).view("<u8").T)
    out = np.empty((BLOCK, packed.shape[0]), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        out[i] = words[word] >> np.uint64(shift)
        if shift + width > 64:
            out[i] |= words[word + 1] << np.uint64(64 - shift)
        out[i] &= mask
    return out.T


def encode_ids(ids: np.ndarray) -> bytes:
    """The payload of a segment."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    grid = np.full(blocks * BLOCK, ids[-1] if n else 0, np.int64)
    grid[:n] = ids
    grid = grid.reshape(blocks, BLOCK)
    low = grid.min(axis=1) if blocks else np.zeros(0, np.int64)
    grid = grid - low[:, None]
    if n % BLOCK:
        grid[-1, n % BLOCK:] = 0
    place = BLOCK * PERCENTILE // 100
    width = _bits(np.partition(grid, place, axis=1)[:, place]) if blocks else low
    beyond = (grid >> width[:, None]) != 0
    odd = beyond.sum(axis=1)
    size = _HEAD + BLOCK // 8 * width + 5 * odd
    start = np.cumsum(size) - size
    data = np.zeros(int(size.sum()), np.uint8)
    head = np.empty((blocks, _HEAD), np.uint8)
    head[:, :4] = low.astype("<u4").view(np.uint8).reshape(blocks, 4)
    head[:, 4], head[:, 5] = width, odd
    data[start[:, None] + np.arange(_HEAD)] = head
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        packed = _pack(np.where(beyond[rows], 0, grid[rows]), w)
        data[start[rows][:, None] + _HEAD + np.arange(packed.shape[1])] = packed
    row, col = np.nonzero(beyond)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(odd) - odd, odd)
    at = (start + _HEAD + BLOCK // 8 * width)[row]
    data[at + nth] = col
    value = (at + odd[row] + 4 * nth)[:, None] + np.arange(4)
    data[value] = grid[row, col].astype("<u4").view(np.uint8).reshape(-1, 4)
    return b"".join((MAGIC, np.array([n], "<u8").tobytes(), np.array([blocks], "<u4").tobytes(),
                     start.astype("<u4").tobytes(), data.tobytes()))


def decode_ids(payload: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids ``first`` to before ``last`` of a segment, decoding only their blocks."""
    raw = np.frombuffer(payload, np.uint8)
    if raw[:4].tobytes() != MAGIC:
        raise ValueError("not a segment of token ids")
    n = int(raw[4:12].view("<u8")[0])
    blocks = int(np.frombuffer(payload, "<u4", 1, 12)[0])
    last = n if last is None else min(last, n)
    if first >= last:
        return np.zeros(0, np.uint32)
    a, b = first // BLOCK, -(-last // BLOCK)
    start = np.frombuffer(payload, "<u4", b - a, 16 + 4 * a).astype(np.int64)
    data = raw[16 + 4 * blocks:]
    head = np.ascontiguousarray(data[start[:, None] + np.arange(_HEAD)])
    low = np.ascontiguousarray(head[:, :4]).view("<u4")[:, 0].astype(np.int64)
    width, odd = head[:, 4].astype(np.int64), head[:, 5].astype(np.int64)
    grid = np.zeros((b - a, BLOCK), np.int64)
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        grid[rows] = _unpack(data[start[rows][:, None] + _HEAD + np.arange(BLOCK // 8 * w)], w)
    row = np.repeat(np.arange(b - a), odd)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(odd) - odd, odd)
    at = (start + _HEAD + BLOCK // 8 * width)[row]
    value = np.ascontiguousarray(data[(at + odd[row] + 4 * nth)[:, None] + np.arange(4)]).view("<u4")[:, 0]
    grid[row, data[at + nth]] = value
    grid += low[:, None]
    return grid.reshape(-1)[first - a * BLOCK:last - a * BLOCK].astype(np.uint32)


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID) -> None:
    """Write the segments of ``docs`` (doc_id, text) in ascending id order."""
    spark = docs.sparkSession
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .withColumn("_hash", F.xxhash64("text")).withColumn("_tie", F.monotonically_increasing_id())
               .repartitionByRange(shuffle_tasks(spark), "doc_id", "_hash", "_tie")
               .sortWithinPartitions("doc_id", "_hash", "_tie").select("doc_id", "text"))

    schema = arrow_schema(SEGMENT)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            for first, texts in text_chunks(b, "text", SEGMENT_BYTES):
                ids, bounds = encode_batch(vocabulary, texts, end_id)
                yield pa.RecordBatch.from_pydict({
                    "part": [part], "seq": [seq], "part_start": [before], "n_ids": [len(ids)],
                    "doc_ids": [b.column("doc_id").slice(first, len(texts)).to_pylist()],
                    "sizes": [np.diff(bounds)], "payload": [encode_ids(ids)]}, schema=schema)
                seq, before = seq + 1, before + len(ids)

    ordered.mapInArrow(run, SEGMENT).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32, and where it lies (part, seq)."""
    stored = spark.read.schema(SEGMENT).parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a row per partition that was written
    starts = (stored.groupBy("part").agg(F.sum("n_ids").alias("n"))
              .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        for r in batch.to_pylist():
            bounds = np.r_[0, np.cumsum(np.array(r["sizes"], np.int64))]
            ids = decode_ids(r["payload"]).astype("<u4")
            yield {"doc_id": r["doc_ids"], "local": r["part_start"] + bounds[:-1], "n_tokens": r["sizes"],
                   "ids_crc32": crc32_rows(ids, bounds), "part": [r["part"]] * len(r["sizes"]),
                   "seq": [r["seq"]] * len(r["sizes"])}

    rows = map_batches(stored.select("part", "seq", "part_start", "doc_ids", "sizes", "payload"), run,
                       "doc_id long, local long, n_tokens long, ids_crc32 long, part int, seq int")
    return (rows.join(F.broadcast(starts), "part")
            .select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", "part", "seq"))


def op1_pfor_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm", "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, vocabulary_path())
    return read_tokens(spark, path)
