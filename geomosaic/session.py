"""Session helpers: a local session for tests, and the shared work folder of a cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# The JVM never compiles a method of more than 8000 bytes of code. Above that, generated
# code would be interpreted; smaller methods per operator are then several times faster.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cpus: str = "8", app: str = "geomosaic", **extra: str) -> SparkSession:
    """A UTC session on this machine, for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (RECOMMENDED | extra).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a folder of this machine.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="geomosaic-")
        spark.conf.set(CHECKPOINT_KEY, base)
    return base.rstrip("/")


def run_dir(spark: SparkSession) -> str:
    """The folder of this application below the shared one; ``close_work`` removes it."""
    return f"{shared_dir(spark)}/geomosaic/{spark.sparkContext.applicationId}"


def work_path(spark: SparkSession, name: str) -> str:
    """A new path for one table of this run; never reused."""
    return f"{run_dir(spark)}/{name}/{uuid.uuid4().hex}"


def close_work(spark: SparkSession) -> None:
    """Remove what this application has staged and checkpointed, once its results are read or stored."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage on shared storage, so that lost executors cost nothing."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{run_dir(spark)}/checkpoints")
    return df.checkpoint()


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several later steps read, and read it back by column."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
