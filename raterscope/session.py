"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str = "8", name: str = "raterscope") -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


#: Most bytes of files, and of shuffled rows, that one task is given where the amount of input decides.
TASK_BYTES = 16 << 20
TASK_SETTINGS = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")


def bound_tasks(spark: SparkSession) -> None:
    """Lower the session's bytes per task to TASK_BYTES; smaller settings stay.

    Rows of long tables take ten times their stored bytes and more in a sort or an aggregation, so
    tasks of the default size need gigabytes.
    """
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for name in TASK_SETTINGS:
        if size(spark.conf.get(name)) > TASK_BYTES:
            spark.conf.set(name, str(TASK_BYTES))


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder the session names in spark.checkpoint.dir.

    Only a local session without the setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="raterscope-")
        spark.sparkContext.setCheckpointDir(folder)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; nothing is created yet."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write rows that several branches of a plan need, and read them back.

    The table lies in the shared folder, so it outlives lost executors, ends the lineage,
    and lets every branch read only its columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
