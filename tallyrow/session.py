"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# AQE splits a hot join key over several tasks and coalesces small shuffle
# partitions. These are the settings the operators count on.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Small data on one machine: keep every core busy instead of merging partitions.
LOCAL_CONF = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyrow")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in {**ADAPTIVE_CONF, **LOCAL_CONF, **conf}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or else the context's checkpoint folder.

    Only a local session with neither gets a temporary folder: on a cluster a
    machine-local path is lost with its executor.
    """
    context = spark.sparkContext
    named = context.getConf().get(CHECKPOINT_DIR) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyrow-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read on from there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a parquet table below the shared folder, for results read more than once.

    Unlike a cache it survives the loss of executors, and later plans start at the table.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
