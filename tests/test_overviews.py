"""The stored overview: later runs against a full rebuild, and what they read and write."""

import datetime
import pathlib
import random

from pyspark.sql import functions as F

from geomosaic.functions import scales
from geomosaic.operators import catalog, overviews

TOP, CELL, SIZE = 1000.0, 20.0, 4
BLOCKS = "dataset string, name string, values array<double>, n_rows int, n_cols int, cell double, x_min double, y_max double"
ITEMS = "dataset string, name string, start_date timestamp_ntz"


def tiles(seed, n, prefix="t", reach=900):
    rng = random.Random(seed)
    day = datetime.datetime(2024, 1, 1)
    blocks, items = [], []
    for k in range(n):
        name, dataset = f"{prefix}{k:03d}", rng.choice(["A", "B"])
        values = [rng.choice([None, -1.0, 5e9, float(k), float(k) + 0.5]) for _ in range(24)]
        blocks.append((dataset, name, values, 4, 6, 10.0, float(rng.randrange(0, reach, 7)), TOP - rng.randrange(0, reach, 7)))
        items.append((dataset, name, rng.choice([None, day, day, day + datetime.timedelta(days=rng.randrange(9))])))
    return blocks, items


def run(spark, store, blocks, items):
    return overviews.update(store, spark.createDataFrame(blocks, BLOCKS), spark.createDataFrame(items, ITEMS), F.lit(CELL), TOP, SIZE)


def cells(spark, store):
    return sorted((r.dataset, r.out_row, r.out_col, r.v, r.name) for r in overviews.read_store(spark, store).collect())


def plain(blocks, items):
    base = datetime.datetime(2050, 1, 1)
    dates = {(d, n): t for d, n, t in items}
    best = {}
    for dataset, name, values, n_rows, n_cols, cell, x_min, y_max in blocks:
        start = dates[dataset, name]
        order = (start is None, abs(base - start) if start else None, name)
        for row in range(60):
            for col in range(60):
                c, r = ((col + 0.5) * CELL - x_min) // cell, (y_max - (TOP - (row + 0.5) * CELL)) // cell
                if 0 <= c < n_cols and 0 <= r < n_rows:
                    v = values[int(r * n_cols + c)]
                    if v is not None and scales.VALID_LOW <= v <= scales.VALID_HIGH:
                        key = (dataset, row, col)
                        if key not in best or order < best[key][0]:
                            best[key] = (order, v, name)
    return sorted((*k, v, name) for k, (_, v, name) in best.items())


def test_runs_equal_a_full_rebuild_and_can_be_repeated(spark, tmp_path):
    first, second, third = tiles(1, 60), tiles(2, 25, "s"), tiles(3, 5, "a", 90)
    store = str(tmp_path / "store")
    for blocks, items in (first, second, third, second):
        run(spark, store, blocks, items)
    whole = [a + b + c for a, b, c in zip(first, second, third, strict=True)]
    assert cells(spark, store) == cells(spark, run(spark, str(tmp_path / "whole"), *whole)) == plain(*whole)


def test_a_run_reads_and_writes_dirty_blocks_only(spark, tmp_path):
    store = str(tmp_path / "store")
    run(spark, store, *tiles(1, 60))
    before = {p: p.stat().st_mtime_ns for p in pathlib.Path(store).rglob("*.parquet")}
    few = tiles(4, 3, "z", 60)
    dirty = overviews.dirty_blocks(spark.createDataFrame(few[0], BLOCKS), F.lit(CELL), TOP, SIZE)
    touched = {(r.dataset, r.block) for r in dirty.collect()}
    assert 0 < len(touched) < len({p.parent for p in before}) / 4
    read = overviews.held_cells(overviews.read_store(spark, store), dirty)
    assert "PartitionFilters: [block" in read._jdf.queryExecution().executedPlan().toString()
    assert {(r.dataset, r.block) for r in read.select("dataset", "block").distinct().collect()} <= touched
    run(spark, store, *few)
    for path, stamp in before.items():
        place = (path.parent.parent.name.removeprefix("dataset="), path.parent.name.removeprefix("block="))
        assert (path.exists() and path.stat().st_mtime_ns == stamp) == (place not in touched)


def test_record_has_extent_and_cell_of_what_was_written(spark, tmp_path):
    store = str(tmp_path / "store")
    blocks, items = tiles(1, 40)
    run(spark, store, blocks, items)
    sources = spark.createDataFrame(items, ITEMS).withColumns(
        {"tag": F.lit("t")} | {c: F.lit(0.0) for c in ("x_min", "y_min", "x_max", "y_max")}
    )
    sources = sources.unionByName(sources.limit(1).withColumn("dataset", F.lit("unwritten")))
    found = {r.dataset: r for r in overviews.records(overviews.read_store(spark, store), sources, F.lit(CELL), TOP, F.lit("o")).collect()}
    assert set(found) == {"A", "B"}
    for dataset, row in found.items():
        rows, cols = zip(*[(r, c) for d, r, c, _, _ in plain(blocks, items) if d == dataset], strict=True)
        assert (row.x_min, row.x_max) == (min(cols) * CELL, (max(cols) + 1) * CELL)
        assert (row.y_max, row.y_min) == (TOP - min(rows) * CELL, TOP - (max(rows) + 1) * CELL)
        assert (row.n_cols, row.low_ps, row.category) == (max(cols) - min(cols) + 1, CELL, catalog.CATEGORY_OVERVIEW)


def test_runs_without_items_or_valid_pixels(spark, tmp_path):
    store = str(tmp_path / "store")
    empty = run(spark, store, [("A", "x", [None] * 24, 4, 6, 10.0, 0.0, TOP)], [("A", "x", None)])
    assert (overviews.read_store(spark, empty) or spark.range(0)).count() == 0
    blocks, items = tiles(1, 10)
    run(spark, store, blocks, items)
    run(spark, store, [], [])
    assert cells(spark, store) == plain(blocks, items)
