"""Footprints, outlines and cell-size groups against plain loops."""

import itertools
import random

from pyspark.sql import functions as F

from geomosaic import plans
from geomosaic.functions import scales
from geomosaic.operators import aggregates, shapes
from geomosaic.plans import views

SF_DIR = "/root/testdata/sf0.001"

BLOCKS = "id int, values array<double>, n_rows int, n_cols int, cell double, x_min double, y_max double"


def area(ring):
    return sum(a[0] * b[1] - a[1] * b[0] for a, b in zip(ring, ring[1:] + ring[:1], strict=True)) / 2


def plain_hull(points):
    """Corners of the hull: points with all others on one side of some line through them and a second corner."""
    points, out = sorted(set(points)), set()
    for a, b in itertools.permutations(points, 2):
        turns = [(b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]) for p in points]
        if all(t >= 0 for t in turns):
            line = [p for p, t in zip(points, turns, strict=True) if t == 0]
            out |= {min(line), max(line)}
    ring, here = [], min(out, key=lambda p: (p[1], p[0]))
    while here not in ring:
        ring.append(here)
        here = next(b for b in out if b != here and all((b[0] - here[0]) * (p[1] - here[1]) >= (b[1] - here[1]) * (p[0] - here[0]) for p in out))
    return ring


def test_footprints_equal_plain_hulls(spark):
    rng, rows = random.Random(5), []
    for k in range(40):
        n_rows, n_cols = rng.randrange(1, 7), rng.randrange(1, 8)
        share = rng.choice([0.1, 0.3, 0.9])
        values = [rng.choice([1.0, 0.0]) if rng.random() < share else rng.choice([None, -1.0, float("nan"), 5e9]) for _ in range(n_rows * n_cols)]
        rows.append((k, values, n_rows, n_cols, 1.0, 0.0, 0.0))
    rows += [(40, None, 2, 2, 1.0, 0.0, 0.0), (41, [], 0, 0, 1.0, 0.0, 0.0)]
    found = shapes.footprint_corners(spark.createDataFrame(rows, BLOCKS), ["id"], max_corners=1000).collect()
    for (k, values, _, n_cols, *_), r in zip(rows, sorted(found), strict=True):
        valid = [i for i, v in enumerate(values or []) if v is not None and scales.VALID_LOW <= v <= scales.VALID_HIGH]
        points = [(i % n_cols + a, -(i // n_cols) - b) for i in valid for a in (0, 1) for b in (0, 1)]
        ring = plain_hull(points) if points else []
        assert (r.id, r.n_valid, [(c.x, c.y) for c in r.corners]) == (k, len(valid), ring)
        assert r.area == (area(ring) if ring else None)


def test_footprint_query_equals_plain_hulls(spark):
    found = {r.vec_id: r for r in plans.QUERIES["agg_footprint_corners"](spark, SF_DIR).collect()}
    tiles = views.tiles(spark, SF_DIR).select("vec_id", "values", "x_min", "y_max").collect()
    assert len(found) == len(tiles)
    for t in tiles:
        valid = [i for i, v in enumerate(t["values"]) if scales.VALID_LOW <= v <= scales.VALID_HIGH]
        rows = {}
        for i in valid:
            rows.setdefault(i // 8, []).append(i % 8)
        ring = plain_hull([(x + a, -r - b) for r, cols in rows.items() for x in (min(cols), max(cols)) for a in (0, 1) for b in (0, 1)])
        while len(ring) > 12:
            losses = [area(ring) - area(ring[:k] + ring[k + 1 :]) for k in range(len(ring))]
            del ring[losses.index(min(losses))]
        places = [(t.x_min + x * 450, t.y_max + y * 450) for x, y in ring]
        assert found[t.vec_id].corners == ",".join(f"{x} {y}" for x, y in places)
        assert (found[t.vec_id].n_valid, found[t.vec_id].area) == (len(valid), area(ring) * 450 * 450)


def test_footprints_lose_the_corners_that_cost_least(spark):
    size = 41
    disc = [1.0 if (x - 20) ** 2 + (y - 20) ** 2 <= 400 else None for y in range(size) for x in range(size)]
    blocks = spark.createDataFrame([(1, disc, size, size, 30.0, 1000.0, 5000.0)], BLOCKS)
    whole, cut = (shapes.footprint_corners(blocks, ["id"], max_corners=n).first() for n in (1000, 12))
    ring = [((c.x - 1000) / 30, (c.y - 5000) / 30) for c in whole.corners]
    while len(ring) > 12:
        losses = [area(ring) - area(ring[:k] + ring[k + 1 :]) for k in range(len(ring))]
        del ring[min(range(len(ring)), key=lambda k: (round(losses[k], 6), k))]
    assert [((c.x - 1000) / 30, (c.y - 5000) / 30) for c in cut.corners] == ring
    assert len(whole.corners) > 12 == len(cut.corners) and 0.9 * whole.area < cut.area < whole.area


def plain_rings(cells):
    """Rings of directed edges, traced one by one, left turns first."""
    steps = [(1, 0), (0, 1), (-1, 0), (0, -1)]
    edges = set()
    for x, y in cells:
        corners = [(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1)]
        edges |= {(a, way) for way, a in enumerate(corners) if (x + [0, 1, 0, -1][way], y + [-1, 0, 1, 0][way]) not in cells}
    rings = []
    while edges:
        at, way = min(edges)
        ring = []
        while (at, way) in edges:
            edges.remove((at, way))
            ring.append(at)
            at = (at[0] + steps[way][0], at[1] + steps[way][1])
            way = next((w % 4 for w in (way + 1, way, way + 3) if (at, w % 4) in edges), way)
        rings.append(ring)
    return rings


def turned(ring):
    k = ring.index(min(ring))
    return min(tuple(ring[i:] + ring[:i]) for i, p in enumerate(ring) if p == ring[k])


def test_outlines_equal_traced_rings(spark):
    rng = random.Random(9)
    groups = {
        "random": {(rng.randrange(12), rng.randrange(12)) for _ in range(90)},
        "frame": {(x, y) for x in range(5) for y in range(5)} - {(1, 1), (2, 2), (3, 1)},
        None: {(0, 0), (1, 1), (-3, 5)},
        "long": {(x, 0) for x in range(70)} | {(0, y) for y in range(40)},
        "one": {(7, -2)},
    }
    rows = [(g, x, y) for g, cells in groups.items() for x, y in cells]
    rings = shapes.outline(spark.createDataFrame(rows, "dataset string, cell_x long, cell_y long").repartition(3))
    found = {}
    for r in rings.orderBy("place").collect():
        found.setdefault((r.dataset, r.ring), []).append(((r.x, r.y), (r.x1, r.y1), r.place))
    by_group = {}
    for (group, _), ring in found.items():
        assert [p for *_, p in ring] == list(range(len(ring)))
        assert all(a[1] == b[0] for a, b in zip(ring, ring[1:] + ring[:1], strict=True))
        by_group.setdefault(group, []).append([a for a, *_ in ring])
    for group, cells in groups.items():
        assert sorted(map(turned, by_group[group])) == sorted(map(turned, plain_rings(cells)))
        assert sum(map(area, by_group[group])) == len(cells)
    areas = shapes.ring_areas(rings, 10.0)
    assert sorted(r.area for r in areas.where("dataset = 'frame'").collect()) == [-300.0, 2500.0]  # holes that touch are one
    assert shapes.outline(spark.createDataFrame([], "dataset string, cell_x long, cell_y long")).count() == 0


def plain_groups(sizes):
    out = []
    for s in sorted(s for s in sizes if s is not None and s > 0):
        if out and out[-1][-1] >= s * 0.8:
            out[-1].append(s)
        else:
            out.append([s])
    return [(k, len(g), g[0], g[-1]) for k, g in enumerate(out, 1)]


def test_cell_sizes_are_grouped_by_their_gaps(spark):
    rng = random.Random(2)
    groups = {
        "many": [rng.uniform(1, 1.2) * 2 ** rng.randrange(6) for _ in range(300)],
        "chain": [1.2**k for k in range(30)],
        "edge": [8.0, 10.0, 12.5, 12.500001, 15.7],
        None: [None, 0.0, -1.0, 5.0, 5.0],
    }
    rows = [(g, s) for g, sizes in groups.items() for s in sizes]
    found = aggregates.cell_size_groups(spark.createDataFrame(rows, "dataset string, low_ps double")).collect()
    for group, sizes in groups.items():
        mine = sorted((r.size_group, r.n_items, r.size_min, r.size_max) for r in found if r.dataset == group)
        assert mine == plain_groups(sizes)


def test_histogram_has_no_row_per_value(spark):
    pixels = spark.range(5000).select((F.col("id") % 2).alias("g"), (F.col("id") / 7.0).alias("v"))
    found = aggregates.histogram(pixels, ["g"], 4)
    assert found.agg(F.sum("n_pixels")).first()[0] == 5000 and found.count() == 8
