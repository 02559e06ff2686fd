"""Envelopes in web mercator against densely sampled edges, and boxes across the antimeridian."""

import random

import pytest
from pyspark.sql import functions as F

from geomosaic.functions import projection
from geomosaic.operators import mosaic, pixels

WORLD = projection.WORLD
SCHEMA = "id int, epsg int, x_min double, y_min double, x_max double, y_max double"


def utm_boxes():
    rng = random.Random(11)
    rows = [
        (32610, 100_000, 6_600_000, 900_000, 7_000_000),  # wide, over the meridian
        (32733, 100_000, 2_000_000, 900_000, 3_000_000),
        (32601, 200_000, -300_000, 400_000, 500_000),  # over the equator, west of the meridian
        (32760, 600_000, 9_700_000, 850_000, 10_400_000),
        (32660, 700_000, 8_000_000, 900_000, 8_400_000),  # over the antimeridian
    ]
    for _ in range(25):
        x, y = rng.uniform(120_000, 800_000), rng.uniform(-500_000, 9_000_000)
        zone, south = rng.randrange(1, 61), rng.random() < 0.5
        y = 10_000_000 - y if south else y
        rows.append(((32700 if south else 32600) + zone, x, y, x + rng.uniform(1, 500_000), y + rng.uniform(1, 500_000)))
    return [(k, c, *map(float, b)) for k, (c, *b) in enumerate(rows)]


def test_envelope_is_that_of_sampled_edges(spark):
    df = spark.createDataFrame(utm_boxes(), SCHEMA)
    steps = F.transform(F.sequence(F.lit(0), F.lit(400)), lambda i: i / 400.0)
    t = F.explode(steps).alias("t")
    x, y = (lambda t: F.expr(f"x_min + {t} * (x_max - x_min)")), (lambda t: F.expr(f"y_min + {t} * (y_max - y_min)"))
    edges = df.select("id", "epsg", "x_min", "y_min", "x_max", "y_max", t).select(
        "id", "epsg", F.inline(F.array(
            F.struct(x("t").alias("x"), F.col("y_min").alias("y")), F.struct(x("t").alias("x"), F.col("y_max").alias("y")),
            F.struct(F.col("x_min").alias("x"), y("t").alias("y")), F.struct(F.col("x_max").alias("x"), y("t").alias("y")),
        )),
    )
    placed = projection.to_mercator(edges, "epsg", {"p": F.col("x")}, {"q": F.col("y")})
    sampled = placed.groupBy("id").agg(F.min("mx_pq").alias("w"), F.min("my_pq").alias("s"), F.max("mx_pq").alias("e"), F.max("my_pq").alias("n"))
    rows = pixels.project_extent(df).join(sampled, "id").collect()
    assert len(rows) == 30 and all(r.reject_reason is None for r in rows)
    for r in rows:
        turn = round((r.w - r.mx_min) / (2 * WORLD)) * 2 * WORLD
        for found, seen in ((r.mx_min, r.w - turn), (r.my_min, r.s)):
            assert -1e-6 <= seen - found < 2.0
        for found, seen in ((r.mx_max, r.e - turn), (r.my_max, r.n)):
            assert -1e-6 <= found - seen < 2.0
        assert -WORLD <= r.mx_min < WORLD
    assert any(r.mx_max > WORLD for r in rows)


def test_corners_alone_would_be_too_small(spark):
    box = spark.createDataFrame([(1, 32633, 300_000.0, 6_600_000.0, 700_000.0, 7_000_000.0)], SCHEMA)
    corners = projection.to_mercator(box, "epsg", {"0": F.col("x_min"), "1": F.col("x_max")}, {"1": F.col("y_max")}).first()
    assert pixels.project_extent(box).first().my_max - max(corners.my_01, corners.my_11) > 5_000


def test_poles_antimeridian_and_boxes_that_are_none(spark):
    rows = [
        (1, 4326, 170.0, -90.0, 190.0, 95.0), (2, 4326, 190.0, 10.0, 200.0, 20.0), (3, 4326, -180.0, 0.0, 180.0, 1.0),
        (4, 4326, 5.0, 0.0, 4.0, 1.0), (5, 3857, 0.0, 0.0, float("inf"), 1.0), (6, 32600, 0.0, 0.0, 1.0, 1.0), (7, 32661, 0.0, 0.0, 1.0, 1.0),
        (8, None, 0.0, 0.0, 1.0, 1.0), (9, 3857, None, 0.0, 1.0, 1.0), (10, 4326, float("nan"), 0.0, 1.0, 1.0), (11, 3857, 3.0, 4.0, 3.0, 4.0),
        (12, 4326, -500.0, 0.0, 500.0, 1.0),
    ]
    done = {r.id: r for r in pixels.project_extent(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {k: r.reject_reason for k, r in done.items() if r.reject_reason} == {
        4: "extent", 5: "extent", 6: "epsg", 7: "epsg", 8: "epsg", 9: "extent", 10: "extent"
    }
    assert all(done[k].mx_min is None for k in (4, 5, 6, 9))
    degree = WORLD / 180
    assert (done[1].mx_min, done[1].mx_max) == (pytest.approx(170 * degree), pytest.approx(190 * degree))
    assert (done[1].my_min, done[1].my_max) == (-WORLD, WORLD)
    assert (done[2].mx_min, done[2].mx_max) == (pytest.approx(-170 * degree), pytest.approx(-160 * degree))
    assert (done[3].mx_min, done[3].mx_max) == (-WORLD, WORLD) and (done[12].mx_min, done[12].mx_max) == (-WORLD, WORLD)
    assert (done[11].mx_min, done[11].my_max) == (3.0, 4.0)
    assert pixels.project_extent(spark.createDataFrame([], SCHEMA)).count() == 0


def test_parts_of_the_world(spark):
    rows = [(1, 3857, 0.0, 0.0, 5.0, 5.0), (2, 3857, WORLD - 2, 0.0, WORLD + 3, 1.0), (3, 3857, None, 0.0, None, 1.0)]
    parts = pixels.world_parts(spark.createDataFrame(rows, SCHEMA)).orderBy("id", "_part").collect()
    assert [(r.id, r._part, r._part_min, r._part_max) for r in parts] == [
        (1, 0, 0.0, 5.0), (2, 0, WORLD - 2, WORLD), (2, 1, -WORLD, pytest.approx(-WORLD + 3)), (3, 0, None, None)
    ]


def test_a_request_finds_items_across_the_antimeridian_once(spark):
    items = [("inside", 0.0, 10.0), ("crossing", WORLD - 5, WORLD + 5), ("west", -WORLD, -WORLD + 2), ("east", WORLD - 2, WORLD), ("whole", -WORLD, WORLD)]
    asked = [(1, WORLD - 3, WORLD), (2, -WORLD, -WORLD + 1), (3, WORLD - 1, WORLD + 1), (4, -WORLD, WORLD), (5, 3.0, 4.0)]

    def pieces(low, high):
        return [(low, min(high, WORLD))] + ([(-WORLD, high - 2 * WORLD)] if high > WORLD else [])

    want = sorted(
        (r, n) for r, a, b in asked for n, c, d in items if any(p < v and u < q for p, q in pieces(a, b) for u, v in pieces(c, d))
    )
    i = spark.createDataFrame([(n, a, 0.0, b, 9.0, None, None, None, None) for n, a, b in items],
                              "name string, x_min double, y_min double, x_max double, y_max double, min_ps double, max_ps double, start_date timestamp_ntz, end_date timestamp_ntz")
    r = spark.createDataFrame([(k, a, 1.0, b, 2.0, 10.0, None, None) for k, a, b in asked],
                              "request_id int, rx_min double, ry_min double, rx_max double, ry_max double, cell double, t_from timestamp_ntz, t_to timestamp_ntz")
    found = mosaic.select_items(i, r)
    assert sorted((x.request_id, x.name) for x in found.collect()) == want
    assert set(found.columns) == set(i.columns) | set(r.columns)
    assert {(x.name, x.x_min, x.x_max) for x in found.collect()} <= set(items)
