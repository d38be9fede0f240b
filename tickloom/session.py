"""Session set-up and the shared folder for state that must outlive an executor."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tickloom")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TICKLOOM_DRIVER_MEMORY", "6g"))
        .config("spark.ui.showConsoleProgress", "false")
        # Local tables are small; the default minimum of 1 MB would leave one task per stage.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: there the driver and the
    executors are the same machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder, for what is of no use after the session.

    The folder is deleted when the session's driver ends.
    """
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def kept(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to a folder of :func:`run_dir` and read back: for rows that are dear to make and read several times."""
    path = run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
