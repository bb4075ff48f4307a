"""Writers: table overwrite / append, versioned tables, keyed merges, relational republish, quality reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.sinks.lake import TABLE, Lake
from tidewater.sinks.upsert import merge_changes, replace_touched, upsert


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet",
                    partition_by: Sequence[str] = (), overwrite_schema: bool = True) -> None:
    """Replace the table and its schema (full recompute of a layer).

    The rows go into a new version of a :class:`~tidewater.sinks.lake.Lake` at
    ``path``, which becomes visible when it is whole: a job that fails leaves
    the former table. Read it with :func:`tidewater.sources.lake.read_table`.
    A format with versions of its own (delta) is written as it is."""
    if fmt != "delta":
        Lake(df.sparkSession, path).replace(TABLE, df, fmt=fmt, partition_by=partition_by)
        return
    w = df.write.format(fmt).mode("overwrite")
    if overwrite_schema:
        w = w.option("overwriteSchema", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def append_table(df: DataFrame, path: str, fmt: str = "parquet",
                 partition_by: Sequence[str] = (), merge_schema: bool = True) -> None:
    """Append; new columns are allowed.

    A table written by :func:`overwrite_table` gets another version; elsewhere
    files are added, and columns are merged on read."""
    if fmt != "delta" and Lake.at(df.sparkSession, path):
        Lake(df.sparkSession, path).append(TABLE, df, fmt=fmt, partition_by=partition_by)
        return
    w = df.write.format(fmt).mode("append")
    if merge_schema:
        w = w.option("mergeSchema", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               mode: str = "overwrite", num_partitions: int | None = None,
               batch_size: int = 10_000) -> None:
    """Republish a (small, aggregated) table to a relational database.

    The executors write in parallel (``num_partitions`` connections at most);
    overwrite drops and recreates the table, no index column is added."""
    out = df.coalesce(num_partitions) if num_partitions else df
    w = (out.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
         .option("batchsize", str(batch_size)))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def write_report(report: DataFrame, path: str) -> None:
    """Append a quality report (JSON lines), partitioned by run date."""
    (report.withColumn("run_date", F.to_date("run_timestamp"))
     .write.mode("append").partitionBy("run_date").json(path))


__all__ = ["Lake", "append_table", "merge_changes", "overwrite_table", "replace_touched", "upsert",
            "write_jdbc", "write_report"]
