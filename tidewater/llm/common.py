"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_path


TASK_ROWS = 50_000        # narrow rows that are worth a task of their own
MIN_TASKS = 8
BATCH_ROWS = 500          # whole texts that go to Python at once


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Cuts the lineage with files that survive a lost executor, and gives the
    planner the true size of what follows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Plans that run inside hand whole texts to Python by so many rows.

    By Spark's 10,000, a task's texts are one Arrow batch, which the executor and its worker both hold."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which comes of about so many narrow ``rows``, by as many tasks as those are worth.

    A small table in many shuffle partitions costs a task and a file for each.
    """
    tasks = max(MIN_TASKS, -(-rows // TASK_ROWS))
    return df.coalesce(tasks) if tasks < shuffle_tasks(df.sparkSession) else df


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one, that no column of ``df`` has (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_chunks(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[tuple[int, list[str | None]]]:
    """Cut a record batch into runs of rows of about ``max_bytes`` bytes of text.

    Bounds what a task holds beside its Arrow batch; a longer text is a chunk
    of its own. Yields (first row, texts).
    """
    texts = batch.column(column)
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first, before = 0, 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, before + max_bytes, "right")))
        yield first, texts.slice(first, last - first).to_pylist()
        first, before = last, int(ends[last - 1])


class Vocabulary(dict):
    """Numbers words from 0 in the order in which they are first looked up."""

    def __missing__(self, word) -> int:
        n = self[word] = len(self)
        return n


_CACHES: list = []


def worker_cache(cached):
    """Register a cached function whose results outlive a task (an encoder); :func:`tidy_worker` empties it."""
    _CACHES.append(cached)
    return cached


def tidy_worker(keep: bool = False) -> None:
    """Give a Python worker's unused memory back; unless ``keep``, drop what other operators have cached in it.

    Workers serve one operator after another, and their memory counts as the executor's. What is dropped may
    refer to itself (a table to the encoder that fills it), so it goes only when it is collected."""
    import ctypes
    import gc

    if not keep and any(cached.cache_info().currsize for cached in _CACHES):
        for cached in _CACHES:
            cached.cache_clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):   # another C library keeps what it likes
        pass


def map_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` for a function from one record batch to dicts of columns, which uses no cached encoder."""
    arrow = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy_worker()           # before it takes memory of its own
        for b in batches:
            if b.num_rows:
                for cols in fn(b):
                    yield pa.RecordBatch.from_pydict(cols, schema=arrow)
        b = cols = None         # an idle worker holds no rows
        tidy_worker(keep=True)

    return df.mapInArrow(run, schema)


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a DDL string (on the driver: it needs a session)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def crc32_rows(data: np.ndarray, bounds: np.ndarray) -> list[int]:
    """Unsigned crc32 of each slice ``data[bounds[i]:bounds[i+1]]`` (its raw bytes)."""
    import zlib

    raw = memoryview(np.ascontiguousarray(data)).cast("B") if data.size else memoryview(b"")
    w = data.itemsize
    return [zlib.crc32(raw[a * w:b * w]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


MAP_BITS = 1 << 25


def hash_bitmap(df: DataFrame, column: str, bits: int = MAP_BITS) -> np.ndarray:
    """A bit map of fixed size in which the low bits of every hash are set.

    Spark builds it in blocks of 32768 bits; at most ``bits`` of them reach the
    driver, whatever ``df`` holds. :func:`in_bitmap` reads it.
    """
    place = F.col(column).bitwiseAND(bits - 1) + 1
    rows = (df.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("k"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("block")).collect())
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        block = np.frombuffer(r["block"], np.uint8)
        at = (r["k"] - 1) * 4096
        out[at:at + len(block)] = block[:len(out) - at]
    return out


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes (int64) have their bit set; others are surely not in the map."""
    place = hashes & (len(bitmap) * 8 - 1)
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def utf8_len(col) -> Column:
    """Bytes of the UTF-8 text; a null text has none."""
    return F.coalesce(F.octet_length(col), F.lit(0)).cast("long")
