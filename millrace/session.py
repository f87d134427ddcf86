"""Session settings shared by every job."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings that can be changed on a running session.  The shuffle partition
# count is left to the cluster: AQE coalesces small partitions and splits hot
# ones, so a high initial count is safe.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split hot join partitions even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

STATIC_CONF = {
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    # Drop checkpoint files once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str, master: str | None = None,
                  log_level: str = "WARN", **conf: str) -> SparkSession:
    """Create (or get) the session; the master is normally left to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**STATIC_CONF, **RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables.

    ``spark.checkpoint.dir`` names it.  Only a local master may go without: it
    then gets a fresh temporary folder, because driver and executors share one
    disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, deleted when the session ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def _place(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def make_folder(spark: SparkSession, path: str) -> None:
    system, at = _place(spark, path)
    system.mkdirs(at)


def delete_folder(spark: SparkSession, path: str) -> None:
    system, at = _place(spark, path)
    system.delete(at, True)


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session for the block; streams started there keep them."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, its lineage cut.

    For small reduced tables that a plan reads several times: without it every
    use would scan the raw data again.  The files survive lost executors.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Persist ``df`` for the block and always release it."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
