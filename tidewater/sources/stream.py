"""Unbounded sources: a message bus topic or a directory of arriving files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_messages(spark: SparkSession, topic: str, servers: str,
                  starting_offsets: str = "earliest", fail_on_data_loss: bool = True,
                  max_offsets_per_trigger: int | None = None,
                  min_partitions: int | None = None,
                  fmt: str = "kafka", options: dict[str, str] | None = None) -> DataFrame:
    """Streaming ``(key, value, topic, partition, offset, timestamp, ...)`` frame.

    ``fail_on_data_loss`` defaults to true: a sink with a checkpoint is only
    exactly-once if lost offsets stop the query instead of being skipped.
    ``max_offsets_per_trigger`` bounds one micro-batch (a large backlog is
    drained in bounded batches), and ``min_partitions`` splits the offset
    ranges of a topic with few partitions over more tasks, without a shuffle.
    Needs the Kafka source package on the class path.
    """
    r = (spark.readStream.format(fmt)
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_partitions:
        r = r.option("minPartitions", str(min_partitions))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load()


def read_file_stream(spark: SparkSession, path: str, schema: StructType | str,
                     fmt: str = "parquet", max_files_per_trigger: int | None = None,
                     options: dict[str, str] | None = None) -> DataFrame:
    """Stream of rows from files landing under ``path`` (a directory or glob).

    A file source needs an explicit schema; ``max_files_per_trigger`` bounds the
    size of one micro-batch."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path)
