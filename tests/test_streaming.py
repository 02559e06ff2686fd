"""Streams over several files and batches give what a batch job gives."""

import datetime
import re

from pyspark.sql import functions as F

from geomosaic.streaming import ingest

ROWS = "path string, dataset string, start_date timestamp"


def land(spark, folder, rows):
    df = spark.createDataFrame(rows, "path string, dataset string, at string").select(
        "path", "dataset", F.col("at").cast("timestamp").alias("start_date")
    )
    df.coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(folder)


def test_ingest_adds_each_path_once(spark, tmp_path):
    landed, held = str(tmp_path / "in"), str(tmp_path / "catalog")
    land(spark, landed, [("a", "d", "2024-01-01"), ("a", "d", "2024-01-01"), ("b", "d", "2024-01-02")])
    land(spark, landed, [("b", "d", "2024-01-02"), ("c", "d", "2024-01-03")])
    ingest.ingest_catalog(stream(spark, landed), held, str(tmp_path / "c1"))
    # later, an old path is listed again, and a scene of long ago is listed for the first time
    land(spark, landed, [("a", "d", "2024-03-01"), ("d", "d", "2014-03-01")])
    ingest.ingest_catalog(stream(spark, landed), held, str(tmp_path / "c1"))
    # and a new stream reads everything from the start
    ingest.ingest_catalog(stream(spark, landed), held, str(tmp_path / "c2"))
    assert sorted(r.path for r in spark.read.parquet(held).collect()) == ["a", "b", "c", "d"]


def test_extent_widens_over_batches(spark, tmp_path):
    landed, state = str(tmp_path / "in"), str(tmp_path / "state")
    land(spark, landed, [("a", "d", "2024-01-05"), ("b", "e", "2024-01-07")])
    land(spark, landed, [("c", "d", "2024-01-02"), ("f", "d", "2024-01-09")])
    ingest.live_extent(stream(spark, landed), state, str(tmp_path / "c"))
    land(spark, landed, [("g", "e", "2024-01-01")])
    ingest.live_extent(stream(spark, landed), state, str(tmp_path / "c"))
    got = {r.dataset: (str(r.overview_start), str(r.overview_end)) for r in ingest.read_extent(spark, state).collect()}
    assert got == {
        "d": ("2024-01-01 16:00:00", "2024-01-09 08:00:00"),
        "e": ("2023-12-31 16:00:00", "2024-01-07 08:00:00"),
    }


def plain_windows(rows):
    days = [(d, datetime.date.fromisoformat(at[:10])) for _, d, at in rows if at]
    out = {}
    for dataset, day in days:
        for back in range(21):
            key = (dataset, day - datetime.timedelta(days=back))
            out[key] = out.get(key, 0) + 1
    return sorted((*k, k[1] + datetime.timedelta(days=21), n) for k, n in out.items())


def test_sliding_counts_lose_no_late_item_and_count_no_batch_twice(spark, tmp_path):
    landed, sink = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [("a", "d", "2024-01-01 12:00:00"), ("b", "d", "2024-01-02 12:00:00"), ("n", "d", None), ("e", "e", "2024-03-01 00:00:00")]
    late = [("c", "d", "2024-01-24 00:00:00"), ("old", "d", "2013-05-05 01:00:00"), ("new", "e", "2024-03-02 23:59:59")]
    land(spark, landed, rows)
    ingest.daily_deltas(stream(spark, landed), sink, str(tmp_path / "c"))
    assert sorted(map(tuple, ingest.sliding_counts(spark, sink).collect())) == plain_windows(rows)
    land(spark, landed, late[:1])
    land(spark, landed, late[1:])
    ingest.daily_deltas(stream(spark, landed), sink, str(tmp_path / "c"))
    assert sorted(map(tuple, ingest.sliding_counts(spark, sink).collect())) == plain_windows(rows + late)
    # the last batch runs again, as after a crash between its write and its commit
    for name in ("2", ".2.crc"):
        (tmp_path / "c" / "commits" / name).unlink(missing_ok=name.startswith("."))
    ingest.daily_deltas(stream(spark, landed), sink, str(tmp_path / "c"))
    assert sorted(map(tuple, ingest.sliding_counts(spark, sink).collect())) == plain_windows(rows + late)


def test_batches_are_bounded_and_read_their_buckets_only(spark, tmp_path):
    landed, held = str(tmp_path / "in"), str(tmp_path / "catalog")
    for part in range(5):
        land(spark, landed, [(f"p{k}", "d", "2024-01-01") for k in range(part * 10, part * 10 + 14)])
    bounded = ingest.landed_stream(spark, landed, spark.read.parquet(landed).schema, files_per_batch=2)
    ingest.ingest_catalog(bounded, held, str(tmp_path / "c"), buckets=16)
    assert len([p for p in (tmp_path / "c" / "commits").iterdir() if p.name.isdigit()]) >= 3
    assert sorted(r.path for r in spark.read.parquet(held).collect()) == sorted(f"p{k}" for k in range(54))
    rows = spark.read.parquet(held).limit(1)
    read = ingest.held_paths(spark, held, rows)
    files = {p.rsplit("bucket=", 1)[1].split("/")[0] for p in read.inputFiles()}
    assert re.search(r"PartitionFilters: \[[^]]*bucket", read._jdf.queryExecution().executedPlan().toString())
    assert read.select("bucket").distinct().collect() == rows.select("bucket").collect() and len(files) >= 1
    before = spark.read.parquet(held).count()
    ingest.append_by_bucket(rows.drop("bucket"), held, 16)
    assert spark.read.parquet(held).count() == before
