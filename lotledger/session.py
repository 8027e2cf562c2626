"""Session helpers and the shared scratch area used to cut lineage."""

from __future__ import annotations

import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_STORED: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def build_session(master: str | None = None, app_name: str = "lotledger", **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC dates.

    The master, memory and shuffle width are left to ``spark-submit`` unless given.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Split a skewed join even where the next join on the same key then shuffles again.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the one the cluster names, or one in the warehouse."""
    named = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/.scratch").rstrip("/")


def new_location(spark: SparkSession, label: str) -> str:
    """An unused path under the shared folder, in this application's own subfolder.

    Tables that are not discarded are left there; the subfolder can go once the application has ended.
    """
    return f"{shared_dir(spark)}/lotledger/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, rows_per_file: int = 0, codec: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where a result is read more than once: later passes prune columns, and a lost
    executor re-reads files instead of recomputing the joins and aggregates behind them. Rows
    that cost much to work on and compress well, as pages do, are spread by ``rows_per_file``.
    The shuffle files of the write go with its end; they would else stay until the driver collects.
    """
    spark = df.sparkSession
    path = new_location(spark, label)
    write = df.write.option("maxRecordsPerFile", rows_per_file)
    before = spark.conf.get(CLEANUP_SETTING, "false")
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        (write.option("compression", codec) if codec else write).parquet(path)
    finally:
        spark.conf.set(CLEANUP_SETTING, before)
    stored = spark.read.schema(df.schema).parquet(path)
    _STORED[stored] = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Remove materialised tables, once all that is made from them has been written itself."""
    for df in stored:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(_STORED.pop(df))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
