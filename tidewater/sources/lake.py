"""Batch scan of a lake table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidewater.sinks.lake import TABLE, Lake


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: StructType | None = None, merge_schema: bool = False) -> DataFrame:
    """Read a table directory. ``fmt`` is any installed source (parquet, orc,
    json, delta when its package is on the class path). ``merge_schema``
    reconciles files appended with evolving schemas (parquet merges on read).
    Column pruning and filter push-down come from the source; nothing is read
    eagerly. A versioned table (``overwrite_table``) is read as of its last
    whole version."""
    if fmt != "delta" and Lake.at(spark, path):
        return Lake(spark, path).read(TABLE)
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if merge_schema:
        r = r.option("mergeSchema", "true")
    return r.load(path)
