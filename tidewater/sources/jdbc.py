"""Relational snapshots read by the executors over JDBC.

The reads are split into ``num_partitions`` range predicates on a numeric,
date or timestamp column, so each executor task fetches one slice; nothing is
pulled through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, DecimalType, TimestampNTZType,
                               TimestampType)

from tidewater.sinks import append_table


def read_snapshot(spark: SparkSession, url: str, table: str,
                  properties: dict[str, str] | None = None,
                  partition_column: str | None = None, lower_bound=None, upper_bound=None,
                  num_partitions: int | None = None, fetch_size: int = 10_000,
                  single_task: bool = False) -> DataFrame:
    """Full snapshot (``SELECT *``) of ``table``.

    Without a partition column one task fetches the whole table, which a caller has to ask for
    by ``single_task``: it suits small dimensions only."""
    if bool(partition_column) == single_task:
        raise ValueError("name a partition_column, or say single_task=True for a table that one task can fetch")
    r = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
         .option("fetchsize", str(fetch_size)))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned reads need lower_bound, upper_bound and num_partitions")
        r = (r.option("partitionColumn", partition_column)
             .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
             .option("numPartitions", str(num_partitions)))
    return r.load()


def read_incremental(spark: SparkSession, url: str, table: str, watermark_column: str,
                     since, properties: dict[str, str] | None = None,
                     **partitioning) -> DataFrame:
    """Rows changed after a high-water mark: the predicate runs in the database
    (pushed filter), so only new rows travel. Append the result to the staging
    table and keep ``max(watermark_column)`` as the next mark."""
    df = read_snapshot(spark, url, table, properties, **partitioning)
    return df.filter(F.col(watermark_column) > F.lit(since))


def load_increment(new: DataFrame, path: str, watermark_column: str, since=None) -> object:
    """Append the rows of ``new`` above the mark ``since`` to the table at ``path``.

    Returns the next mark: the largest value that was appended, or ``since``
    where nothing was newer. The mark comes from the writing job itself."""
    seen = Observation("increment")
    rows = new if since is None else new.filter(F.col(watermark_column) > F.lit(since))
    append_table(rows.observe(seen, F.max(watermark_column).alias("mark")), path)
    mark = seen.get["mark"]
    return since if mark is None else mark


def conform_types(df: DataFrame, decimals_to_double: bool = True,
                  legacy_text: bool = False) -> DataFrame:
    """Type conformance of extracted columns.

    Default: keep the native JDBC types and real NULLs, only DECIMAL -> DOUBLE
    (the summary casts budgets to double anyway). ``legacy_text=True`` gives the
    older contract of text times and text for every non-numeric, non-boolean
    column, numbers as double — still with NULLs kept as NULL.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        t = f.dataType
        if isinstance(t, DecimalType) and (decimals_to_double or legacy_text):
            c = c.cast("double")
        elif legacy_text and isinstance(t, (TimestampType, TimestampNTZType, DateType)):
            c = c.cast("string")
        elif legacy_text and not isinstance(t, BooleanType) and t.typeName() not in (
                "byte", "short", "integer", "long", "float", "double"):
            c = c.cast("string")
        elif legacy_text and t.typeName() in ("byte", "short", "integer", "long", "float"):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)
