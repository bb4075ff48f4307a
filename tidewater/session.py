"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this library should carry. Shuffle partitions are
# only a starting point: AQE coalesces small partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # streaming session windows: merge a key's events into sessions inside each
    # input partition before the shuffle (the batch plan always does), so a hot
    # key ships partial sessions rather than raw events to its state task
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # streaming state (dedup keys within the watermark, open sessions) lives in
    # RocksDB on local disk instead of the executor heap, and each commit
    # uploads only a changelog; in-memory state would not hold billions of keys
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, app: str = "tidewater",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster ``master`` stays ``None`` so spark-submit decides; tests and
    the bench pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Directory for checkpoints, stream state and intermediate tables.

    The cluster names a shared folder in ``spark.checkpoint.dir``; it is read
    from the session and used as is. A machine's own folder would be invisible
    to other executors, so only a ``local`` master may go without the setting:
    a private scratch folder is created and registered then."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tidewater-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh location below :func:`shared_root` for one run of one job."""
    return "/".join([shared_root(spark), "tidewater", *parts, uuid.uuid4().hex])


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that a finished job no longer needs, wherever it is stored."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


__all__ = ["build_session", "shared_root", "scratch_path", "remove_path", "DEFAULT_CONF"]
