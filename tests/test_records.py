"""Record pages and committed runs."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from geomosaic.operators import records
from geomosaic.sources import writers

DAY = datetime.datetime(2024, 1, 1)
SCHEMA = "name string, k int, x_min double, y_min double, x_max double, y_max double, start_date timestamp_ntz, end_date timestamp_ntz"


def items():
    rng = random.Random(1)
    rows = []
    for i in range(230):
        x, y = rng.randrange(100), rng.randrange(100)
        start = rng.choice([None, DAY + datetime.timedelta(days=rng.randrange(30))])
        rows.append((f"n{i:03d}", rng.choice([None, 1, 2, 3]), x, y, x + 9.0, y + 9.0, start, start))
    return [(n, k, float(x), float(y), a, b, s, e) for n, k, x, y, a, b, s, e in rows]


@pytest.mark.parametrize("time", [None, (DAY, None), (None, DAY + datetime.timedelta(days=9)), (DAY, DAY + datetime.timedelta(days=20))])
def test_pages_joined_are_the_whole_result(spark, time):
    rows = items()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    order, box = ["k", "name"], (20.0, 10.0, 90.0, 95.0)
    low, high = time or (None, None)
    want = [
        r for r in rows
        if r[0] != "n007" and r[2] < box[2] and r[4] > box[0] and r[3] < box[3] and r[5] > box[1]
        and (time is None or r[6] is not None and (low is None or r[7] >= low) and (high is None or r[6] <= high))
    ]
    want = [r[0] for r in sorted(want, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))]
    found, after = [], None
    while True:
        page = records.records(df, order, ["name", "k"], "name <> 'n007'", box, time, after, limit=25)
        names = [r.name for r in page.collect()]
        assert len(names) <= 25
        if not names:
            break
        found += names
        after = records.last_key(page, order)
    assert found == want and len(want) > 25
    assert records.last_key(page, order) is None


def test_a_page_is_a_top_n_behind_a_pushed_bound(spark, tmp_path):
    spark.createDataFrame(items(), SCHEMA).write.parquet(str(tmp_path / "t"))
    page = records.records(spark.read.parquet(str(tmp_path / "t")), ["k", "name"], after=(2, "n100"))
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "GreaterThanOrEqual(k,2)" in plan
    for bad in (0, records.MAX_RECORDS + 1):
        with pytest.raises(ValueError, match="page"):
            records.records(page, ["k"], limit=bad)
    with pytest.raises(ValueError, match="after"):
        records.records(page, ["k", "name"], after=(1,))


def run(spark, names):
    return spark.createDataFrame([("A", 1, n) for n in names], "dataset string, category int, name string")


def test_only_complete_runs_are_read(spark, tmp_path):
    base = str(tmp_path / "runs-of")
    day = lambda n: F.lit(f"2024-01-0{n} 00:00:00").cast("timestamp_ntz")
    assert writers.read_last_run(spark, base) is None and writers.complete_runs(spark, base).count() == 0
    writers.write_run(run(spark, ["a"]), base, "R1", day(1))
    # a newer run breaks off before its manifest
    writers.write_items(run(spark, ["half"]), f"{base}/runs/R2")
    (row,) = writers.read_last_run(spark, base).collect()
    assert (row.name, row.run_name, row.run_stamp) == ("a", "R1", datetime.datetime(2024, 1, 1))
    # it is done again from the start, and once more for nothing
    for names in (["b", "c"], ["other"]):
        writers.write_run(run(spark, names), base, "R2", day(2))
        assert sorted(r.name for r in writers.read_last_run(spark, base).collect()) == ["b", "c"]
    # an older run that comes later is complete but not the last
    writers.write_run(run(spark, ["z"]), base, "R0", day(1))
    assert sorted((r.run_name, r.n_items) for r in writers.complete_runs(spark, base).collect()) == [("R0", 1), ("R1", 1), ("R2", 2)]
    assert writers.read_last_run(spark, base).select("run_name").distinct().collect()[0][0] == "R2"
    writers.write_run(run(spark, []), base, "R3", day(3))
    assert writers.complete_runs(spark, base).where("run_name = 'R3'").first().n_items == 0
