"""Session defaults and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

# Broadcasts are never hinted on data of unknown size: Catalyst and AQE broadcast a side only when
# its measured size is under these thresholds and fall back to a shuffle join (with skew splitting)
# beyond them.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.parquet.compression.codec": "zstd",
    # No call-site capture for every Column: plans over hundreds of columns are built faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "orderflow", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library defaults; keyword arguments use ``__`` for the dots of a setting name."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in DEFAULTS.items():
        builder = builder.config(name, value)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder named by ``spark.checkpoint.dir``; pick one ourselves only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        configured = tempfile.mkdtemp(prefix="orderflow-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def _folder(spark: SparkSession, path: str):
    """The folder and its file system, as the JVM knows them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def pin(df: DataFrame) -> DataFrame:
    """The rows as Parquet files below the checkpoint folder: later reads see one fixed result, also after executors are lost.

    Unlike ``checkpoint``, which keeps the *estimated* size of the plan it cuts, this gives the planner the size of the
    files. In a loop that joins a table with its own aggregates the estimate squares itself each round, until planning
    alone doesn't end. The files go when the application ends, or earlier by ``unpin``."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pinned-{uuid.uuid4().hex}"
    df.write.parquet(path)
    where, files = _folder(spark, path)
    files.deleteOnExit(where)
    pinned = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[pinned] = path
    return pinned


def unpin(*frames: DataFrame) -> None:
    """Delete what ``pin`` wrote for these frames; nothing built on them may be read any more."""
    for df in frames:
        path = _FOLDERS.pop(df, None)
        if path:
            where, files = _folder(df.sparkSession, path)
            files.delete(where, True)


def pin_partitions(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, for rows whose dealing to partitions and order in them must stay."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
