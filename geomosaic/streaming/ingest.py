"""Streams over landed listings: exact-once ingest, live extents, sliding counts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomosaic.functions import dates
from geomosaic.operators.bounded import join_null_safe
from geomosaic.session import reliable_checkpoint

#: Parts of a catalog by hash of the path.
BUCKETS = 256


def landed_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """A stream of the parquet files at a path, so many of them to a batch; without a number all that landed are one."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def ingest_catalog(stream: DataFrame, catalog: str, checkpoint: str, buckets: int = BUCKETS) -> None:
    """Add each streamed path to the catalog once, then stop when the input is used up.

    The catalog is laid out by a hash of the path, and a batch is compared with the buckets of its own paths only. That
    comparison makes the result exact for repeats in one batch and over batches, for a batch that runs again, and for a new stream
    over old files, so the stream holds no state and no scene is too old. One writer per catalog, with one number of buckets.
    """

    def add(batch: DataFrame, _batch_id: int) -> None:
        append_by_bucket(batch, catalog, buckets)

    query = (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def append_by_bucket(rows: DataFrame, catalog: str, buckets: int = BUCKETS) -> None:
    """Append the rows whose path the catalog lacks, each path once."""
    spark = rows.sparkSession
    placed = rows.withColumn("bucket", F.pmod(F.xxhash64("path"), F.lit(buckets)).cast("int"))
    unique = reliable_checkpoint(placed.dropDuplicates(["path"]))
    held = held_paths(spark, catalog, unique)
    new = unique if held is None else unique.join(held, ["bucket", "path"], "left_anti")
    new.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(catalog)


def held_paths(spark: SparkSession, catalog: str, rows: DataFrame) -> DataFrame | None:
    """(bucket, path) of the catalog in the buckets of ``rows``, whose number is bounded; None before the first run."""
    wanted = [r.bucket for r in rows.select("bucket").distinct().collect()]
    try:
        held = spark.read.schema("path string, bucket int").parquet(catalog)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return held.where(F.col("bucket").isin(wanted))


def live_extent(stream: DataFrame, state: str, checkpoint: str, group: str = "dataset") -> None:
    """Keep first and last start per dataset; each batch appends the groups it changed.

    First and last only ever widen, so readers fold the appended rows, and a batch that
    runs again changes nothing.
    """
    changed = stream.groupBy(group).agg(F.min("start_date").alias("first_start"), F.max("start_date").alias("last_start"))

    def save(batch: DataFrame, _batch_id: int) -> None:
        batch.write.mode("append").parquet(state)

    query = (
        changed.writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_extent(spark: SparkSession, state: str, group: str = "dataset") -> DataFrame:
    """The current overview extents from the appended state."""
    return spark.read.parquet(state).groupBy(group).agg(
        dates.overview_start(F.min("first_start").cast("timestamp_ntz")).alias("overview_start"),
        dates.overview_end(F.max("last_start").cast("timestamp_ntz")).alias("overview_end"),
    )


def daily_deltas(stream: DataFrame, sink: str, checkpoint: str, event_time: str = "start_date", group: str = "dataset") -> None:
    """Write the items per day that each batch adds, under the number of the batch.

    There is no watermark, so no item is too late to count. A batch that runs again replaces what it wrote. One
    stream per sink. Items without a date are in no day.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        day = F.to_date(event_time).alias("day")
        counts = batch.where(F.col(event_time).isNotNull()).groupBy(group, day).agg(F.count("*").alias("n"))
        counts.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    query = (
        stream.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def sliding_counts(spark: SparkSession, sink: str, group: str = "dataset", days: int = 7 * dates.EXTENT_WEEKS) -> DataFrame:
    """(group, window_start, window_end, n_items): the windows of three weeks, by days, that hold an item, as of now.

    The deltas are summed per day, and a window is the difference of two running sums, so an item is read once and
    not once per window.
    """
    deltas = spark.read.schema(f"`{group}` string, day date, n long, batch long").parquet(sink)
    daily = deltas.groupBy(group, "day").agg(F.sum("n").alias("n"))
    ends = daily.groupBy(group).agg(F.min("day").alias("first"), F.max("day").alias("last"))
    each = F.explode(F.sequence(F.date_sub("first", days - 1), F.date_add("last", days - 1), F.expr("interval 1 day")))
    every = join_null_safe(ends.select(group, each.alias("day")), daily, [group, "day"], "left")
    # one row per day of a group
    in_order = Window.partitionBy(group).orderBy("day")
    summed = every.withColumn("upto", F.sum(F.coalesce("n", F.lit(0))).over(in_order))
    before = F.coalesce(F.lag("upto", 1).over(in_order), F.lit(0))
    windows = summed.withColumn("n_items", F.lead("upto", days - 1).over(in_order) - before).where("n_items > 0")
    return windows.select(group, F.col("day").alias("window_start"), F.date_add("day", days).alias("window_end"), "n_items")
