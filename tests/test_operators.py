"""Operators on small frames: properties, edges, skew and brute force."""

import datetime
import functools
import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from geomosaic.functions import projection
from geomosaic.operators import aggregates, blocks, bounded, catalog, mosaic, pixels, quality, serving, spatial, timewin
from geomosaic.operators.spatial import Box, join_boxes
from geomosaic.plans import rastering
from geomosaic.sources import readers, writers


def boxes(seed, n, prefix, sizes):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x, y = rng.randint(-50, 300), rng.randint(-50, 300)
        w, h = rng.choice(sizes), rng.choice(sizes)
        out.append((f"{prefix}{i}", float(x), float(y), float(x + w), float(y + h)))
    return out


def frame(spark, rows, prefix):
    names = [f"{prefix}{c}" for c in ("id", "x0", "y0", "x1", "y1")]
    schema = ", ".join([f"{names[0]} string"] + [f"{c} double" for c in names[1:]])
    return spark.createDataFrame(rows, schema), Box(*names[1:])


@pytest.mark.parametrize("meetings", [16_000_000, 25])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_box_join_equals_brute_force(spark, seed, meetings):
    left, right = boxes(seed, 120, "l", (1, 10, 64, 700)), boxes(seed + 10, 80, "r", (2, 16, 33, 250))
    # a third of each side lies on one spot
    left += [(f"h{i}", 10.0, 10.0, 20.0, 20.0) for i in range(60)]
    right += [(f"g{i}", 12.0, 12.0, 13.0, 13.0) for i in range(40)]
    want = sorted(
        (a[0], b[0]) for a in left for b in right if a[1] < b[3] and b[1] < a[3] and a[2] < b[4] and b[2] < a[4]
    )
    (l_df, l_box), (r_df, r_box) = frame(spark, left, "l"), frame(spark, right, "r")
    got = join_boxes(l_df, r_df, l_box, r_box, meetings=meetings).select("lid", "rid").collect()
    assert sorted((r.lid, r.rid) for r in got) == want


@pytest.mark.parametrize("meetings", [16_000_000, 25])
def test_point_join_is_half_open(spark, meetings):
    left = boxes(5, 100, "l", (8, 16, 32)) + [("edge", 0.0, 0.0, 16.0, 16.0)]
    points = [(f"p{i}", float(i % 40 * 4), float(i // 40 * 4)) for i in range(400)]
    want = sorted((a[0], p[0]) for a in left for p in points if a[1] <= p[1] < a[3] and a[2] <= p[2] < a[4])
    l_df, l_box = frame(spark, left, "l")
    p_df = spark.createDataFrame(points, "pid string, px double, py double")
    got = join_boxes(
        l_df, p_df, l_box, Box("px", "py", "px", "py"), half_open=True, meetings=meetings
    ).collect()
    assert sorted((r.lid, r.pid) for r in got) == want


def test_box_join_without_rows_or_extents(spark):
    l_df, l_box = frame(spark, [("a", None, 0.0, 1.0, 1.0)], "l")
    r_df, r_box = frame(spark, [("b", 0.0, 0.0, 1.0, 1.0)], "r")
    assert join_boxes(l_df, r_df, l_box, r_box).count() == 0


@pytest.mark.parametrize("meetings", [16_000_000, 400])
def test_timed_join_equals_brute_force(spark, meetings):
    rng = random.Random(8)
    base = datetime.datetime(2024, 1, 1)

    def spans(n, lengths):
        out = []
        for _ in range(n):
            start = base + datetime.timedelta(hours=rng.randint(-200, 200))
            span = (start, start + datetime.timedelta(hours=rng.choice(lengths)))
            out.append(rng.choice([span, span, span, (None, None), (start, None)]))
        return out

    # all on one spot, parted by their dates only
    left = [(f"l{i}", 0.0, 0.0, 8.0, 8.0, a, b) for i, (a, b) in enumerate(spans(150, (0, 0, 3, 5000)))]
    right = [(f"r{i}", 1.0, 1.0, 3.0, 3.0, a, b) for i, (a, b) in enumerate(spans(60, (1, 24, 240)))]
    want = sorted(
        (p[0], q[0])
        for p in left
        for q in right
        if None in p[5:] or None in q[5:] or (p[5] <= q[6] and q[5] <= p[6])
    )
    schema = "{0}id string, {0}x0 double, {0}y0 double, {0}x1 double, {0}y1 double, {0}t0 timestamp_ntz, {0}t1 timestamp_ntz"
    names = [["x0", "y0", "x1", "y1", "t0", "t1"], ["x0", "y0", "x1", "y1", "t0", "t1"]]
    l_df, r_df = (spark.createDataFrame(rows, schema.format(p)) for rows, p in ((left, "l"), (right, "r")))
    l_box, r_box = (Box(*[p + n for n in ns]) for p, ns in zip("lr", names, strict=True))
    got = join_boxes(l_df, r_df, l_box, r_box, meetings=meetings).collect()
    assert sorted((r.lid, r.rid) for r in got) == want
    with pytest.raises(ValueError, match="times"):
        join_boxes(l_df, r_df, l_box, Box("rx0", "ry0", "rx1", "ry1"))


def test_a_crowd_of_small_boxes_is_parted(spark):
    """All boxes and points lie in one place; far fewer pairs are looked at than there are."""
    rng = random.Random(4)
    rows = [(f"l{i}", x, y, x + 3.0, y + 3.0) for i in range(3000) for x, y in [(rng.random() * 900, rng.random() * 900)]]
    l_df, box = frame(spark, rows, "l")
    p_df = spark.createDataFrame([(rng.random() * 900, rng.random() * 900) for _ in range(3000)], "px double, py double")
    point = Box("px", "py", "px", "py")
    l_known = l_df.withColumns({"_l_own": spatial.native_level(box), "_l_time": spatial.native_time_level(box)})
    p_known = p_df.withColumns({"_r_own": spatial.native_level(point), "_r_time": spatial.native_time_level(point)})
    found = spatial._levels(l_known, p_known, [])
    l_levels, p_levels = ([r for r in found if r["side"] == side] for side in "lr")
    per_cell = {}
    for side, placed in enumerate(
        (
            spatial._place(l_known, box, "l", p_levels, []),
            spatial._place(p_known, point, "r", l_levels, []),
        )
    ):
        for row in placed.groupBy("_level", "_cx", "_cy").count().collect():
            per_cell.setdefault(tuple(row)[:3], [0, 0])[side] = row["count"]
    looked_at = sum(a * b for a, b in per_cell.values())
    assert looked_at < 3000 * 3000 / 500
    assert join_boxes(l_df, p_df, box, point, half_open=True).count() <= looked_at


def test_a_hot_cell_is_cut_by_its_product(spark):
    """Equal rows on one cell: no task takes more than the set number of meetings, and slices are about square."""
    same = spark.range(2000).select(F.lit(1.01).alias("x0"), F.lit(1.01).alias("y0"), F.lit(1.49).alias("x1"), F.lit(1.49).alias("y1"))
    other = same.limit(900).selectExpr("x0 as u0", "y0 as v0", "x1 as u1", "y1 as v1")
    left, right, meetings = Box("x0", "y0", "x1", "y1"), Box("u0", "v0", "u1", "v1"), 40_000
    assert join_boxes(same, other, left, right, meetings=meetings).count() == 2000 * 900
    l_fixed, r_fixed = spatial._fixed(same, left, "l", False), spatial._fixed(other, right, "r", False)
    levels = spatial._levels(l_fixed, r_fixed, [])
    l_cells = spatial._place(l_fixed, left, "l", [r for r in levels if r["side"] == "r"], [])
    r_cells = spatial._place(r_fixed, right, "r", [r for r in levels if r["side"] == "l"], [])
    (hot,) = spatial.hot_cells(l_cells, r_cells, spatial._CELL, meetings).collect()
    assert (hot["_nl"], hot["_nr"]) == (10, 5)
    table = spatial.hot_cells(l_cells, r_cells, spatial._CELL, meetings)
    keys = [*spatial._CELL, "_sl", "_sr"]
    l_cut = spatial._slice(l_cells, table, spatial._CELL, "_nl", "_nr", "_sl", "_sr").groupBy(keys).agg(F.count("*").alias("l"))
    r_cut = spatial._slice(r_cells, table, spatial._CELL, "_nr", "_nl", "_sr", "_sl").groupBy(keys).agg(F.count("*").alias("r"))
    met = [r.l * r.r for r in l_cut.join(r_cut, keys).collect()]
    assert len(met) == 50 and sum(met) == 2000 * 900 and max(met) < 2 * meetings


@pytest.mark.parametrize("wide", ["l", "r"])
def test_the_side_with_more_bytes_is_not_repeated(spark, wide):
    """Rows of the wide side have one cell per level, and corners on the edges of cells are found once from either side."""
    rng = random.Random(9)

    def rows(n):
        out = [(f"{k}", x, y, x + w, y + w) for k in range(n) for x, y, w in [(rng.randrange(-64, 64) / 2, rng.randrange(-64, 64) / 2, rng.choice([0.5, 1.0, 8.0, 3.0, 16.0]))]]
        return out + [("far", -1e300, -1e300, 1e300, 1e300), ("dot", 2.0, 2.0, 2.0, 2.0), ("tiny", -1e-12, -1e-12, 1e-12, 1e-12)]

    left, right = rows(150), rows(150)
    (l_df, l_box), (r_df, r_box) = frame(spark, left, "l"), frame(spark, right, "r")
    l_df, r_df = (df.withColumn(f"{p}_long", F.repeat(F.lit("x"), 500 if p == wide else 1)) for df, p in ((l_df, "l"), (r_df, "r")))
    want = sorted((a[0], b[0]) for a in left for b in right if a[1] < b[3] and b[1] < a[3] and a[2] < b[4] and b[2] < a[4])
    for meetings in (16_000_000, 30):
        got = join_boxes(l_df, r_df, l_box, r_box, meetings=meetings)
        assert sorted((x.lid, x.rid) for x in got.collect()) == want
    l_fixed, r_fixed = spatial._fixed(l_df, l_box, "l", False), spatial._fixed(r_df, r_box, "r", False)
    levels = spatial._levels(l_fixed, r_fixed, [])
    of = {side: sum(x["bytes"] for x in levels if x["side"] == side) for side in "lr"}
    assert of[wide] > max(v for k, v in of.items() if k != wide)
    fixed, box, other = (l_fixed, l_box, "r") if wide == "l" else (r_fixed, r_box, "l")
    placed = spatial._place(fixed, box, wide, [x for x in levels if x["side"] == other], [], True)
    assert placed.groupBy(f"{wide}id", "_level").count().where("count > 1").count() == 0


def test_rectangles_do_not_grow_with_the_meetings(spark, monkeypatch):
    """With more meetings in all, a rectangle takes more of them, so rows are not repeated more often."""
    monkeypatch.setattr(spatial, "MOST_CUT", 20)
    same = spark.range(2000).selectExpr("id as lid", "1.01D as x0", "1.01D as y0", "1.49D as x1", "1.49D as y1")
    other = spark.range(900).selectExpr("id as rid", "1.01D as u0", "1.01D as v0", "1.49D as u1", "1.49D as v1")
    found = join_boxes(same, other, Box("x0", "y0", "x1", "y1"), Box("u0", "v0", "u1", "v1"), meetings=1000)
    assert found.rdd.getNumPartitions() <= 20 and found.distinct().count() == 2000 * 900


def test_meetings_make_tasks_and_not_the_files(spark):
    """Few rows that meet often, from one file each, are dealt to as many tasks as their meetings ask for."""
    start, end = "timestamp_micros(id) as", "timestamp_micros(id + 50) as"
    left = spark.range(300).coalesce(1).selectExpr("id as lid", "1.01D as x0", "1.01D as y0", "1.49D as x1", "1.49D as y1", f"{start} s", f"{end} e")
    right = spark.range(200).coalesce(1).selectExpr("id as rid", "1.01D as u0", "1.01D as v0", "1.49D as u1", "1.49D as v1", f"{start} p", f"{end} q")
    spots = Box("x0", "y0", "x1", "y1"), Box("u0", "v0", "u1", "v1")
    found = join_boxes(left, right, *spots, meetings=1000)
    assert found.rdd.getNumPartitions() >= 60 and found.count() == 300 * 200
    spans = Box("x0", "y0", "x1", "y1", "s", "e"), Box("u0", "v0", "u1", "v1", "p", "q")
    want = {(i, j) for i in range(300) for j in range(200) if abs(i - j) <= 50}
    rows = join_boxes(left, right, *spans, meetings=1000).collect()
    assert len(rows) == len(want) and {(r.lid, r.rid) for r in rows} == want


def test_a_side_that_is_short_stays_whole(spark):
    cells = spark.range(100_000).select(F.lit(0).alias("k"))
    (hot,) = spatial.hot_cells(cells, cells.limit(3), ["k"], 10_000).collect()
    assert (hot["_nl"], hot["_nr"]) == (30, 1)


def test_a_side_of_one_file_is_spread_by_all_cores(spark, tmp_path):
    """The rows that become several each are dealt out first, however few their files are."""
    spark.range(300).coalesce(1).selectExpr("id as lid", "1.01D as x0", "1.01D as y0", "1.49D as x1", "1.49D as y1").write.parquet(f"{tmp_path}/one")
    one = spark.read.parquet(f"{tmp_path}/one").withColumn("_row", F.monotonically_increasing_id())
    cores = spark.sparkContext.defaultParallelism
    spread = spatial._spread_out(one)
    assert one.rdd.getNumPartitions() < cores == spread.rdd.getNumPartitions() and spread.count() == 300


def test_slices_of_long_rows_are_short(spark):
    """Rows of 100 times the bytes are repeated a tenth as often as if both sides counted the same."""
    counted = spark.createDataFrame([(0, 100_000, 100_000)], "k int, l long, r long")
    (hot,) = spatial.slices_of(counted, ["k"], 10_000, 100.0).collect()
    assert (hot["_nl"], hot["_nr"]) == (10_000, 100)
    (hot,) = spatial.slices_of(counted, ["k"], 10_000, 0.01).collect()
    assert (hot["_nl"], hot["_nr"]) == (100, 10_000)


def test_boxes_that_are_none_are_told_with_a_reason(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("ok", 0.0, 0.0, 1.0, 1.0), ("inf", 0.0, 0.0, inf, 1.0), ("low", -inf, 0.0, 1.0, 1.0), ("nan", 0.0, nan, 1.0, 1.0),
            ("inv", 1.0, 0.0, 0.0, 1.0), ("null", 0.0, 0.0, 1.0, None)]
    l_df, l_box = frame(spark, rows, "l")
    r_df, r_box = frame(spark, [(f"r{n}", *b) for n, *b in rows], "r")
    found = {r.lid: r.reject_reason for r in spatial.rejected_boxes(l_df, l_box).collect()}
    assert found == {"inf": "infinite", "low": "infinite", "nan": "infinite", "inv": "inverted", "null": "null"}
    assert [(r.lid, r.rid) for r in join_boxes(l_df, r_df, l_box, r_box).collect()] == [("ok", "rok")]


def test_a_zoomed_out_request_meets_no_scene_under_the_overviews(spark):
    """Of the pairs that meet in a cell, none is of a scene whose range does not admit the request."""
    rng = random.Random(6)
    ranges = [(None, 460.0), (450.0, None), (None, None), (100.0, 200.0), (0.0, 1.0), (-3.0, 5.0)]
    items = [(f"i{k}", 0.0, 0.0, 9.0, 9.0, *rng.choice(ranges), None, None) for k in range(300)]
    cells = [30.0, 455.0, 2000.0, 150.0, 0.0, 460.0, 450.0, 1e300, None]
    asked = [(k, 1.0, 1.0, 2.0, 2.0, c, None, None) for k, c in enumerate(cells)]
    i = spark.createDataFrame(items, "name string, x_min double, y_min double, x_max double, y_max double, min_ps double, max_ps double, start_date timestamp_ntz, end_date timestamp_ntz")
    r = spark.createDataFrame(asked, "request_id int, rx_min double, ry_min double, rx_max double, ry_max double, cell double, t_from timestamp_ntz, t_to timestamp_ntz")
    want = sorted(
        (q[0], p[0]) for p in items for q in asked if q[5] is not None and (p[5] or 0.0) <= q[5] and (p[6] is None or q[5] <= p[6])
    )
    assert sorted((x.request_id, x.name) for x in mosaic.select_items(i, r).collect()) == want
    classed, of_class = mosaic.with_resolution_class(i, r)
    met = classed.join(of_class.where("cell = 2000"), "_class")
    assert met.where("max_ps < 2000").count() == 0 and met.count() > 0
    many = spark.range(20_000).select(F.expr("pow(2D, id/200D - 50)").alias("min_ps"), F.lit(None).cast("double").alias("max_ps"))
    assert mosaic.with_resolution_class(many, r)[0].select("_class").distinct().count() <= mosaic.CLASSES


def test_undated_items_fit_only_requests_without_times(spark):
    day = datetime.datetime(2024, 1, 1)
    i = spark.createDataFrame([("dated", day, day), ("open", None, None), ("half", day, None)], "name string, start_date timestamp_ntz, end_date timestamp_ntz")
    r = spark.createDataFrame([(1, None, None), (2, day, day), (3, day, None), (4, None, day)], "request_id int, t_from timestamp_ntz, t_to timestamp_ntz")
    found = {(x.request_id, x.name) for x in i.join(r).where(mosaic.in_time()).collect()}
    assert found == {(1, "dated"), (1, "open"), (1, "half"), (2, "dated"), (3, "dated"), (4, "dated")}


@pytest.mark.parametrize("rows_per_task", [200_000, 150, 40, 1])
def test_rank_of_a_hot_group(spark, rows_per_task):
    rng = random.Random(3)
    rows = [("hot" if i % 3 else f"g{i % 7}", rng.randint(0, 20), f"n{i:04d}") for i in range(900)]
    df = spark.createDataFrame(rows, "g string, k int, name string")
    got = bounded.ranked(df, ["g"], [F.col("k"), F.col("name")], rows_per_task=rows_per_task).collect()
    assert len(got) == len(rows)
    for group in {r[0] for r in rows}:
        want = [r[2] for r in sorted((r for r in rows if r[0] == group), key=lambda r: (r[1], r[2]))]
        mine = [r.name for r in sorted((r for r in got if r.g == group), key=lambda r: r.mosaic_rank)]
        assert mine == want
        assert sorted(r.mosaic_rank for r in got if r.g == group) == list(range(1, len(want) + 1))


def test_rank_spreads_a_hot_group(spark):
    """A group of one day and of no day at all is cut by the later keys; null groups are groups."""
    df = spark.range(4000).select(
        F.when(F.col("id") < 3600, F.lit(None).cast("int")).otherwise(F.lit(1)).alias("g"),
        F.when(F.col("id") % 2 == 0, F.lit(None).cast("int")).otherwise(F.lit(7)).alias("k"),
        F.lpad(F.col("id").cast("string"), 5, "0").alias("name"),
    )
    order = [F.col("k").isNull(), F.col("k"), F.col("name")]
    ranked = bounded.ranked(df, ["g"], order, rows_per_task=320)
    want = sorted(range(3600), key=lambda i: (i % 2 == 0, i))
    found = {int(r["name"]): r.mosaic_rank for r in ranked.where("g is null").collect()}
    assert [found[i] for i in want] == list(range(1, 3601))
    sizes = df.groupBy("g").agg(F.count("*").alias("_rows"))
    cuts = {r.g: r._splitters for r in bounded.splitters(df, sizes, ["g"], order, 320).collect()}
    assert 8 <= len(cuts[None]) <= 16 and len(cuts.get(1, [])) <= 2
    assert cuts == {r.g: r._splitters for r in bounded.splitters(df.repartition(7), sizes, ["g"], order, 320).collect()}
    places = sorted(want.index(int(s.o2)) for s in cuts[None])
    assert max(b - a for a, b in zip([0, *places], [*places, 3600], strict=True)) < 3 * 320
    assert bounded.ranked(df.limit(0), ["g"], order).count() == 0


def test_join_measured_beyond_its_bound(spark):
    big = spark.range(100).withColumn("k", F.col("id") % 10)
    small = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for bound in (100, 3):
        assert bounded.join_measured(big, small, ["k"], max_bytes=bound).where("v = 2 * k").count() == 100


def test_cap_is_planned_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), F.col("id"))
    capped = bounded.first_n(df, ["g"], [F.col("id").desc()], 3)
    plan = capped._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert sorted(r.id for r in capped.collect()) == [994, 995, 996, 997, 998, 999]


def asked_items(spark):
    """Items and requests on a few spots; some ids come twice or are null, one request crosses the world's edge."""
    rng = random.Random(4)
    day = [None, *(datetime.datetime(2024, 1, d) for d in range(1, 9))]
    world = projection.WORLD
    items = []
    for k in range(300):
        x, y, size, when = rng.choice([0, 40, 41]) + rng.random(), rng.choice([0, 40, 41]) + rng.random(), rng.choice([1, 5, 5, 5, 70]), rng.choice(day)
        items.append((f"i{k:03d}", when, when, x, y, x + size, y + size, rng.choice([None, 100.0]), rng.choice([None, 460.0])))
    items += [("edge", day[1], day[1], world - 9, 0.0, world + 9, 9.0, None, None), ("west", None, None, -world, 0.0, -world + 5, 9.0, None, None), ("none", None, None, None, 0.0, 1.0, 1.0, None, None)]
    asked = []
    for k in range(60):
        x, y, size, when = rng.uniform(-5, 60), rng.uniform(-5, 60), rng.choice([0, 3, 3, 9]), rng.choice(day)
        asked.append((None if k == 7 else k % 55, x, y, x + size, y + size, rng.choice([30.0, 455.0, 2000.0]), when, when))
    asked += [(None, 39.0, 39.0, 45.0, 45.0, 90.0, None, None), (90, world - 3, 1.0, world + 3, 2.0, 90.0, None, None), (91, None, 1.0, 2.0, 2.0, 90.0, None, None)]
    i = spark.createDataFrame(items, "name string, start_date timestamp_ntz, end_date timestamp_ntz, x_min double, y_min double, x_max double, y_max double, min_ps double, max_ps double")
    r = spark.createDataFrame(asked, "request_id long, rx_min double, ry_min double, rx_max double, ry_max double, cell double, t_from timestamp_ntz, t_to timestamp_ntz")
    return i, r


@pytest.mark.parametrize(("rows_per_task", "meetings"), [(200_000, 16_000_000), (200_000, 40), (60, 300), (1, 16_000_000)])
def test_order_at_home_is_that_of_all_pairs(spark, rows_per_task, meetings):
    i, r = asked_items(spark)
    for order in (mosaic.by_attribute(), mosaic.by_name()):
        # the same item twice in a request of two rows has either rank
        want = sorted((str(x.request_id), x.mosaic_rank, x["name"]) for x in mosaic.order_items(mosaic.select_items(i, r), order).collect())
        got = mosaic.order_selected(i, r, order, rows_per_task, meetings)
        assert sorted((str(x.request_id), x.mosaic_rank, x["name"]) for x in got.collect()) == want
    assert {"90", "None"} <= {w[0] for w in want}
    assert mosaic.order_selected(i.limit(0), r, order).count() == mosaic.order_selected(i, r.limit(0), order).count() == 0


def test_pairs_do_not_move_to_be_numbered(spark):
    i, r = asked_items(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = mosaic.order_selected(i, r.where("request_id between 10 and 50"), mosaic.by_name())._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    steps = [line.strip(" :+-*") for line in plan.splitlines()]
    below = steps[next(k for k, line in enumerate(steps) if line.startswith("Window ")) :]
    first = {word: next(k for k, line in enumerate(below) if word in line) for word in ("SortMergeJoin", "Exchange")}
    assert first["SortMergeJoin"] < first["Exchange"]


def test_items_are_written_once_to_be_numbered(spark, monkeypatch):
    """Items are stored without their homes, of which each has several, and slices get tasks of their own."""
    written = {}

    def staged(df, name):
        out = bounded.staged(df, name)
        written.setdefault(name, []).append(out.count() if "x_min" in out.columns else 0)
        return out

    i, r = asked_items(spark)
    r = r.where("request_id between 10 and 50")
    monkeypatch.setattr(mosaic, "staged", staged)
    found = mosaic.order_selected(i, r, mosaic.by_name(), meetings=10)
    assert sum(map(sum, written.values())) == i.count()
    assert found.rdd.getNumPartitions() > 100 and found.count() == mosaic.select_items(i, r).count()


def test_identify_moves_no_pair_to_its_block(spark, tmp_path):
    """Points meet the blocks with their values: nothing is joined after the extent join."""
    spark.range(1, 40).select(F.col("id").alias("c_custkey")).write.parquet(f"{tmp_path}/customer.parquet")
    ids = spark.range(50)
    ids.selectExpr("id as vec_id", "cast(id % 10 as int) as label", "transform(sequence(1, 64), k -> cast(k + id as float)) as embedding").write.parquet(f"{tmp_path}/embeddings.parquet")
    ids.selectExpr("id as event_id", "id as user_id", "'view' as event_type", "1D as value", "timestamp_ntz'2024-01-01' as ts").write.parquet(f"{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = rastering.px_identify(spark, str(tmp_path))
        assert found._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == 1
        assert found.count() > 0 and found.where("raw is null or raw % 100 <> 0").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("at_once", [16_000_000, 0])
def test_cap_of_what_is_met_in_rounds(spark, at_once):
    """The leading items of each request, as from all pairs; the first round settles most requests."""
    rng = random.Random(8)
    items = [(f"n{k:04d}", rng.choice([None, *range(40)]), float(x := rng.choice([0, 5, 50])), x + 8.0) for k in range(900)]
    items += [(f"z{k}", None, 200.0, 209.0) for k in range(5)]
    asked = [(None if k == 3 else k % 11, float(a := rng.randint(-5, 60)), a + 9.0) for k in range(14)]
    asked += [(20, 201.0, 202.0), (21, 900.0, 901.0), (None, 200.0, 300.0)]
    i = spark.createDataFrame(items, "name string, day int, x0 double, x1 double")
    r = spark.createDataFrame(asked, "request_id int, a double, b double")
    looked_at = []

    def meet(some, waiting):
        pairs = some.join(waiting, (F.col("x0") < F.col("b")) & (F.col("a") < F.col("x1")))
        looked_at.append(pairs.count())
        return pairs

    got = mosaic.cap_met(i, r, meet, [F.col("day").isNull(), F.col("day"), F.col("name")], 7, at_once=at_once)
    met = {}
    for n, day, x0, x1 in items:
        for q, a, b in asked:
            if x0 < b and a < x1:
                met.setdefault(q, []).append((day is None, day or 0, n))
    want = sorted((str(q), k + 1, p[2]) for q, found in met.items() for k, p in enumerate(sorted(found)[:7]))
    assert sorted((str(x.request_id), x.mosaic_rank, x["name"]) for x in got.collect()) == want
    assert (sum(looked_at) < sum(map(len, met.values())) / 2) == (len(looked_at) > 1) == (at_once == 0)
    assert mosaic.cap_met(i.limit(0), r, meet, [F.col("name")], 7, at_once=at_once).count() == 0


def test_new_paths_once_and_idempotent(spark):
    listing = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "path string")
    held = spark.createDataFrame([("c",)], "path string")
    new = catalog.new_paths(listing, held)
    assert sorted(r.path for r in new.collect()) == ["a", "b"]
    assert catalog.new_paths(listing, catalog.union_catalog(held, new)).count() == 0


def test_route_matches_prefix_and_suffix(spark):
    configs = spark.createDataFrame(
        [("A", "x/", "_VV.tif"), ("B", "x/", "V.tif"), ("C", "", ""), ("D", "y/", ".tif")],
        "dataset_name string, s3_prefix string, s3_suffix string",
    )
    objects = spark.createDataFrame([("x/1_VV.tif",), ("y/2.tif",), ("z",), ("x/_VV.tif",)], "key string")
    got = {(r.key, r.dataset_name) for r in catalog.route(objects, configs).collect()}
    want = {
        (o.key, c.dataset_name)
        for o in objects.collect()
        for c in configs.collect()
        if o.key.startswith(c.s3_prefix) and o.key.endswith(c.s3_suffix)
    }
    assert got == want


def test_season_lookups(spark):
    coded = spark.createDataFrame([("DJF",), ("XXX",)], "season_code string")
    assert {r.season_name for r in catalog.with_season_code(coded, strict=False).collect()} == {"winter", None}
    with pytest.raises(PySparkException, match="unknown season code: XXX"):
        catalog.with_season_code(coded).collect()


def test_path_guard(spark):
    df = spark.createDataFrame([("/vsis3/b/x",), ("/vsis3/c/x",)], "path string")
    flagged = {r.path: r.reject_reason for r in catalog.guard_prefix(df, "/vsis3/b/", strict=False).collect()}
    assert flagged == {"/vsis3/b/x": None, "/vsis3/c/x": "bucket"}
    with pytest.raises(PySparkException, match="outside the bucket"):
        catalog.guard_prefix(df, "/vsis3/b/").collect()


def test_retention_is_strict(spark):
    df = spark.sql(
        "select * from values ('a.gdb', timestamp_ntz'2024-01-23 12:00:00'), ('b.gdb', timestamp_ntz'2024-01-23 11:59:59'),"
        " ('c.csv', timestamp_ntz'2020-01-01') as t(name, mtime)"
    )
    as_of = F.lit("2024-01-31").cast("timestamp_ntz")
    assert [r.name for r in catalog.expired(df, ("gdb", ".sd"), as_of).collect()] == ["b.gdb"]


def test_calculate_fields_sees_old_values(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")
    out = catalog.calculate_fields(df, {"n": "n + 1", "was": "n"}).collect()
    assert [(r.n, r.was) for r in out] == [(2, 1), (3, 2)]
    some = catalog.calculate_fields(df, {"s": F.lit("x")}, where=F.col("n") == 2).collect()
    assert [r.s for r in some] == ["a", "x"]


def test_repair_takes_the_longest_root(spark):
    df = spark.createDataFrame([("/o/c/1",), ("/o/2",), ("/k/3",)], "path string")
    got = [r.path for r in catalog.repair_paths(df, {"/o/": "/n/", "/o/c/": "/m/"}).collect()]
    assert got == ["/m/1", "/n/2", "/k/3"]


def test_transmit_sends_a_field_once(spark):
    df = spark.range(1).selectExpr("1 as a", "2 as b", "3 as c")
    assert catalog.transmit(df, ["b", "a", "b"]).columns == ["b", "a"]


def test_first_merge_does_not_depend_on_order(spark):
    rng = random.Random(9)
    rows = [(c, r, None if rng.random() < 0.3 else float(rng.randint(0, 99))) for c in range(20) for r in range(1, 15)]
    want = {}
    for c, r, v in sorted(rows, key=lambda x: x[1]):
        if v is not None:
            want.setdefault(c, v)
    for partitions in (1, 3, 11):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "c int, mosaic_rank long, v double").repartition(partitions)
        got = {r.c: r.v for r in mosaic.first_merge(df, ["c"]).collect()}
        assert got == want


def test_visibility_is_inclusive(spark):
    df = spark.createDataFrame(
        [("src", None, 1610.0), ("ovr", 1600.0, None)], "name string, min_ps double, max_ps double"
    )
    for cell, want in ((30.0, {"src"}), (1600.0, {"src", "ovr"}), (1610.0, {"src", "ovr"}), (1611.0, {"ovr"})):
        assert {r.name for r in df.where(mosaic.visible_at(F.lit(cell))).collect()} == want


def test_order_puts_newest_first_and_nulls_last(spark):
    df = spark.sql(
        "select * from values (1, 'b', timestamp_ntz'2024-01-01'), (1, 'a', timestamp_ntz'2024-01-01'),"
        " (1, 'c', timestamp_ntz'2024-01-02'), (1, 'd', cast(null as timestamp_ntz)) as t(request_id, name, start_date)"
    )
    got = mosaic.order_items(df, mosaic.by_attribute()).orderBy("mosaic_rank").collect()
    assert [r.name for r in got] == ["c", "a", "b", "d"]


def block(spark, values, n_cols, cell=1.0, x_min=0.0, y_max=None):
    n_rows = len(values) // n_cols
    return spark.createDataFrame(
        [("b", values, n_rows, n_cols, cell, x_min, float(n_rows) if y_max is None else y_max)],
        "id string, values array<double>, n_rows int, n_cols int, cell double, x_min double, y_max double",
    )


def test_resample_takes_the_pixel_under_the_centre(spark):
    df = block(spark, [float(i) for i in range(16)], 4)
    got = {(r.out_col, r.out_row): r.v for r in pixels.resample_nearest(df, ["id"], F.lit(2.0), 4.0).collect()}
    assert got == {(0, 0): 5.0, (1, 0): 7.0, (0, 1): 13.0, (1, 1): 15.0}
    same = {(r.out_col, r.out_row): r.v for r in pixels.resample_nearest(df, ["id"], F.lit(1.0), 4.0).collect()}
    assert same == {(i % 4, i // 4): float(i) for i in range(16)}


def test_footprint_and_empty_block(spark):
    values = [-1.0] * 16
    values[6] = values[9] = 1.0
    row = aggregates.footprint(block(spark, values, 4), ["id"]).first()
    assert (row.n_valid, row.fx_min, row.fx_max, row.fy_min, row.fy_max) == (2, 1.0, 3.0, 1.0, 3.0)
    empty = aggregates.footprint(block(spark, [-1.0] * 4, 2), ["id"]).first()
    assert empty.n_valid == 0 and empty.fx_min is None


def test_statistics_skip(spark):
    df = block(spark, [float(i) for i in range(36)], 6)
    sampled = aggregates.sampled_pixels(df, ["id"]).collect()
    assert sorted((r.row, r.col, r.v) for r in sampled) == [(0, 0, 0.0), (0, 5, 5.0), (5, 0, 30.0), (5, 5, 35.0)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.5, 0.99, 1.0, 1.01, -0.1)], "v double")
    df = df.unionByName(spark.createDataFrame([(None,), (float("nan"),)], "v double")).withColumn("g", F.lit(1))
    got = {r.bin: r.n_pixels for r in aggregates.histogram(df, ["g"], 2).collect()}
    assert got == {1: 2, 2: 4}
    same = df.where("v = 0.5")
    assert [(r.bin, r.n_pixels) for r in aggregates.histogram(same, ["g"], 2).collect()] == [(1, 1)]


def test_long_paths_null_tags_and_null_groups_stay(spark):
    path = "/old/" + "x" * 1_200_000
    moved = catalog.repair_paths(spark.createDataFrame([(path,)], "path string"), {"/old/": "/n/"}).first().path
    assert len(moved) == len(path) - 2
    tags = spark.createDataFrame([("Dataset",), (None,), ("a",)], "tag string")
    assert {r.tag for r in catalog.source_items(tags).collect()} == {None, "a"}
    rows = spark.createDataFrame([(None, 1), (None, 2), ("g", 3)], "g string, k int")
    assert sorted(r.mosaic_rank for r in bounded.ranked(rows, ["g"], [F.col("k")]).collect()) == [1, 1, 2]
    many = bounded.first_n(rows, ["g"], [F.col("k")], 5000)
    assert many.count() == 3


def test_covered_cells_stop_at_the_edge(spark):
    df = spark.createDataFrame(
        [("d", 0.0, 0.0, 10.0, 10.0), ("d", 5.0, 5.0, 20.0, 10.5)],
        "dataset string, x_min double, y_min double, x_max double, y_max double",
    )
    got = {(r.cell_x, r.cell_y) for r in aggregates.covered_cells(df, 10.0).collect()}
    assert got == {(0, 0), (1, 0), (0, 1), (1, 1)}


def test_ingest_counts_of_nothing(spark):
    none = spark.createDataFrame([], "path string")
    row = aggregates.ingest_counts(none, none).first()
    assert (row.n_found, row.n_added) == (0, 0)


def test_trailing_range_has_every_day(spark):
    items = spark.sql("select timestamp_ntz'2024-01-31 12:00:00' as start_date")
    got = timewin.trailing_range(items, F.lit("2024-01-31").cast("timestamp_ntz")).collect()
    assert len(got) == 365
    assert sum(r.n_items for r in got) == 1


def test_quality_checks(spark):
    items = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", 1)], "dataset string, category int"
    )
    listing = spark.createDataFrame([("a",), ("b",), ("c",)], "dataset string")
    ok = {r.dataset: r.ok for r in quality.item_count(items, listing).collect()}
    assert ok == {"a": True, "b": False, "c": False}
    shown = spark.createDataFrame([(0.0,), (100.0,), (0.3,), (50.0,), (99.8,)], "v double")
    row = quality.decimal_display(shown, 2).first()
    assert (row.n_pixels, row.n_collapsed) == (5, 2)


def test_catalog_csv_round_trip_and_missing_file(spark, tmp_path):
    assert readers.read_catalog_csv(spark, str(tmp_path / "none"), ["path", "srs"]).count() == 0
    df = spark.createDataFrame([("b", 'say "x", y'), ("a", "z")], "path string, srs string")
    run = writers.write_catalog_csv(df, str(tmp_path / "run"))
    assert {tuple(r) for r in readers.read_catalog_csv(spark, run, ["path", "srs"]).collect()} == {
        ("b", 'say "x", y'),
        ("a", "z"),
    }


def test_append_twice(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "path string, n int")
    target = str(tmp_path / "catalog")
    for _ in range(2):
        writers.append_catalog(df, target)
    assert sorted(r.path for r in spark.read.parquet(target).collect()) == ["a", "b"]


def test_all_lines_of_a_path_list(spark, tmp_path):
    (tmp_path / "urls.csv").write_text("a\nb\nc\n")
    assert [r.path for r in readers.read_path_list(spark, str(tmp_path / "urls.csv")).collect()] == ["a", "b", "c"]


def test_list_files_reads_no_content(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "x_VV.tif").write_bytes(b"12345")
    (tmp_path / "y.csv").write_bytes(b"1")
    listed = readers.list_files(spark, str(tmp_path), "_VV.tif")
    assert [(r.size, r.path.endswith("x_VV.tif")) for r in listed.collect()] == [(5, True)]
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()


def test_configs_with_and_without_overrides(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n "dataset_name": "A",\n "service_definition_overrides": {"Type": "R"}\n}')
    (tmp_path / "b.json").write_text('{\n "dataset_name": "B",\n "raster_function_templates": []\n}')
    got = {r.dataset_name: r.service_definition_overrides for r in readers.read_configs(spark, str(tmp_path)).collect()}
    assert got == {"A": {"Type": "R"}, "B": None}
    missing = quality.missing_config(readers.read_configs(spark, str(tmp_path)), ("dataset_name", "bucket"))
    assert {tuple(r) for r in missing.collect()} == {("A", "bucket"), ("B", "bucket")}


def test_items_from_damaged_catalog(spark):
    df = spark.createDataFrame([("p", "1", "x", "3", "4")], "path string, x_min string, y_min string, x_max string, y_max string")
    types = {"path": "string", "x_min": "double", "y_min": "double", "x_max": "double", "y_max": "double"}
    row = readers.items_from_catalog(df, types).first()
    assert (row.x_min, row.y_min, row.center_x, row.center_y) == (1.0, None, 2.0, None)


def test_served_items_are_met_by_leading_stretches(spark, monkeypatch):
    rng = random.Random(9)
    day = datetime.datetime(2024, 1, 1)
    items, asked, met = [], [], []
    for k in range(300):
        x, y = rng.uniform(0, 300), rng.uniform(0, 300)
        start = None if k % 50 == 0 else day + datetime.timedelta(hours=rng.randrange(900))
        items.append(("AB"[k % 2], f"n{k:03}", start, start, x, y, x + 200, y + 200, None, 4.0 if k % 3 else None))
    for k in range(40):
        x, y = rng.uniform(0, 400), rng.uniform(0, 400)
        t = day + datetime.timedelta(days=rng.randrange(30)) if k % 2 else None
        asked.append((k, x, y, x + 60, y + 60, rng.choice([1.0, 5.0]), t, None, "AB"[k % 3 % 2]))
    items = spark.createDataFrame(items, "dataset string, name string, start_date timestamp, end_date timestamp, x_min double, y_min double, x_max double, y_max double, min_ps double, max_ps double")
    asked = spark.createDataFrame(asked, "request_id long, rx_min double, ry_min double, rx_max double, ry_max double, cell double, t_from timestamp, t_to timestamp, asked string")
    families = {"A": serving.Family(mosaic.by_attribute, 2, lambda v: v), "B": serving.Family(mosaic.by_name, 3, lambda v: v)}
    want = []
    for name, family in families.items():
        pairs = mosaic.select_items(items, asked).where((F.col("dataset") == name) & (F.col("asked") == name))
        want += mosaic.cap_items(pairs, family.order(), family.cap).select("request_id", "dataset", "name", "mosaic_rank").collect()
    select_items = mosaic.select_items
    monkeypatch.setattr(mosaic, "cap_met", functools.partial(mosaic.cap_met, at_once=0))
    monkeypatch.setattr(mosaic, "select_items", lambda i, r: met.append(i.count() * r.count()) or select_items(i, r))
    got = serving.chosen_items(items, asked, families, "dataset", "asked").collect()
    assert sorted(got) == sorted(want) and len(want) > 60
    assert sum(met) < 300 * 40 / 2 / 2


def test_window_explodes_only_what_it_keeps(spark):
    df = block(spark, [float(i) for i in range(16)], 4)
    got = pixels.explode_window(df, ["id"], (F.lit(-3), F.lit(1)), (F.lit(2), F.lit(9))).collect()
    assert sorted((r.row, r.col, r.v) for r in got) == [(0, 2, 2.0), (0, 3, 3.0), (1, 2, 6.0), (1, 3, 7.0)]
    assert pixels.explode_window(df, ["id"], (F.lit(4), F.lit(9)), (F.lit(0), F.lit(3))).count() == 0


def test_first_fitting_url_of_each_granule(spark, tmp_path):
    def granule(*urls):
        return {"umm": {"RelatedUrls": [{"URL": u, "Type": "GET DATA"} for u in urls]}, "meta": {"x": 1}}

    items = [
        granule("https://h/a_VV.tif", "s3://b/a_VH.tif", "s3://b/a_VV.tif", "s3://b/second_VV.tif"),
        granule("s3://b/c.h5"),
        granule(),
        granule("s3://b/d_VV.tif"),
    ]
    page = tmp_path / "page.json"
    page.write_text(json.dumps({"pol": "VV", "items": items}) + "\n" + json.dumps({"pol": "VH", "items": []}))
    got = readers.granule_paths(readers.read_search_pages(spark, str(page))).collect()
    assert [(r.pol, r.path) for r in got] == [("VV", "/vsis3/b/a_VV.tif"), ("VV", "/vsis3/b/d_VV.tif")]


@pytest.mark.parametrize("hot_parts", [4096, 3])
def test_block_merge_equals_pixel_merge(spark, hot_parts):
    rng = random.Random(6)
    rows = []
    for rank in range(1, 41):
        # a third of the blocks lies on one spot
        row_0, col_0 = (5, 5) if rank % 3 == 0 else (rng.randint(-9, 20), rng.randint(-9, 20))
        n_rows, n_cols = rng.randint(1, 7), rng.randint(1, 7)
        values = [rng.choice([None, -1.0, rng.random(), rng.random()]) for _ in range(n_rows * n_cols)]
        rows.append(("d", rank, row_0, col_0, n_rows, n_cols, values))
    want = {}
    for _, rank, row_0, col_0, n_rows, n_cols, values in rows:
        for k, v in enumerate(values):
            if v is not None and v >= 0:
                want.setdefault((row_0 + k // n_cols, col_0 + k % n_cols), v)
    df = spark.createDataFrame(
        rows,
        "dataset string, mosaic_rank long, row_0 long, col_0 long, n_rows int, n_cols int, values array<double>",
    ).repartition(5)
    merged = blocks.first_merge_blocks(df, ["dataset"], 8, hot_parts=hot_parts)
    got = {(r.grid_row, r.grid_col): r.v for r in blocks.block_cells(merged, ["dataset"], 8).collect()}
    assert got == want
