"""Sinks. Every writer writes a new run path and never the path being read.

A run of items is written aside and becomes visible by its manifest, a single small file that is written last.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geomosaic.operators.bounded import fits_broadcast
from geomosaic.session import reliable_checkpoint


def write_catalog_csv(catalog: DataFrame, path: str, key: str = "path") -> str:
    """The whole catalog in path order, with a header. The sort is a range partitioning."""
    catalog.orderBy(key).write.option("header", True).mode("errorifexists").csv(path)
    return path


def append_catalog(rows: DataFrame, path: str, key: str = "path") -> str:
    """Append the rows whose key the catalog lacks, each once.

    The new rows are fixed first, so that a task that runs again writes the same ones. When
    they are few, the catalog is only filtered by them where it lies; else both sides are
    shuffled by key.
    """
    spark = rows.sparkSession
    unique = reliable_checkpoint(rows.dropDuplicates([key]))
    try:
        held = spark.read.parquet(path).select(key)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        unique.write.mode("append").parquet(path)
        return path
    if fits_broadcast(unique):
        held = held.join(F.broadcast(unique.select(key)), key, "left_semi")
    unique.join(held, key, "left_anti").write.mode("append").parquet(path)
    return path


def write_path_list(paths: DataFrame, path: str) -> str:
    """One path per line, no header."""
    paths.select(F.col("path").alias("value")).write.mode("errorifexists").text(path)
    return path


def write_text_by_dataset(texts: DataFrame, path: str) -> str:
    """One folder of text per dataset."""
    texts.select("dataset", F.col("text").alias("value")).write.mode("errorifexists").partitionBy("dataset").text(path)
    return path


def write_items(items: DataFrame, path: str) -> str:
    """A publishable item table, laid out by dataset and category so that both prune."""
    items.write.mode("errorifexists").partitionBy("dataset", "category").parquet(path)
    return path


def _manifests(spark: SparkSession, base: str) -> DataFrame | None:
    try:
        return spark.read.schema("run_name string, run_stamp timestamp_ntz, n_items long").parquet(f"{base}/manifests/*")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_run(items: DataFrame, base: str, run_name: str, as_of: Column) -> str:
    """Write a run's items with ``run_name`` and ``run_stamp`` stored, then the manifest that makes it visible.

    A run that is complete is left as it is; what a broken one left behind is written anew. One writer per run.
    """
    spark, path = items.sparkSession, f"{base}/runs/{run_name}"
    held = _manifests(spark, base)
    if held is not None and not held.where(F.col("run_name") == run_name).isEmpty():
        return path
    stamp = as_of.cast("timestamp_ntz")
    stamped = items.withColumns({"run_name": F.lit(run_name), "run_stamp": stamp})
    stamped.write.mode("overwrite").partitionBy("dataset", "category").parquet(path)
    written = spark.read.schema(stamped.schema).parquet(path).agg(F.count("*").alias("n_items"))
    done = written.select(F.lit(run_name).alias("run_name"), stamp.alias("run_stamp"), "n_items")
    done.coalesce(1).write.mode("overwrite").parquet(f"{base}/manifests/{run_name}")
    return path


def complete_runs(spark: SparkSession, base: str) -> DataFrame:
    """(run_name, run_stamp, n_items) of every complete run."""
    held = _manifests(spark, base)
    empty = spark.createDataFrame([], "run_name string, run_stamp timestamp_ntz, n_items long")
    return empty if held is None else held


def read_last_run(spark: SparkSession, base: str) -> DataFrame | None:
    """The items of the complete run with the latest stamp (of equal ones the last name); None before the first."""
    last = complete_runs(spark, base).agg(F.max(F.struct("run_stamp", "run_name")).alias("r")).first()["r"]
    return None if last is None else spark.read.parquet(f"{base}/runs/{last.run_name}")
