"""Mosaic operators: item visibility, item order, the item cap, and the FIRST merge."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geomosaic.functions import dates
from geomosaic.functions.projection import WORLD
from geomosaic.operators.bounded import ROWS_PER_TASK, first_n, join_measured, join_null_safe, ranked
from geomosaic.operators.pixels import world_parts
from geomosaic.operators.spatial import MEETINGS, Box, box_fault, join_boxes, native_level, overlap
from geomosaic.session import staged

# Base date of the attribute order, and the request limits.
ORDER_BASE = "2050-01-01 00:00:00"
MAX_DOWNLOADS = 50
MAX_IMAGE_ROWS = 5000
MAX_IMAGE_COLS = 5000
#: Classes of pixel-size ranges that a request is compared with.
CLASSES = 64
#: Homes that an item may be compared with before items are dealt to tasks for it; tasks for each slice of requests at home.
HOMES_EACH, TASKS_EACH = 1000, 4
#: Possible pairs below which all are met at once; else the leading items first, so many for each item of the cap,
#: and so many times more in each further round.
ALL_AT_ONCE, ROUND, WIDER = 16_000_000, 16, 4


def visible_at(cell: Column) -> Column:
    """An item shows at a cell size inside its closed pixel-size range."""
    return (F.coalesce("min_ps", F.lit(0.0)) <= cell) & (
        F.col("max_ps").isNull() | (cell <= F.col("max_ps"))
    )


def in_time() -> Column:
    """Whether an item's dates fit a request: a request without times fits every item, one with a single time is
    open at the other side. Items without dates fit only requests that do not ask for time."""
    return (F.col("t_from").isNull() & F.col("t_to").isNull()) | dates.overlaps(
        F.col("start_date"), F.col("end_date"), F.coalesce("t_from", "end_date"), F.coalesce("t_to", "start_date")
    )


def _step(size: Column, steps: int, without: int) -> Column:
    """Place of a pixel size on a logarithmic scale of ``steps`` per octave."""
    return F.when(size > 0, F.floor(F.log2(size) * steps)).otherwise(F.lit(without)).cast("int")


_ALL = 1_000_000


def with_resolution_class(items: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items with the ``_class`` of their pixel-size range, and a row of a request for each class that may admit its cell.

    Ranges are told apart on a logarithmic scale, as finely as it gives at most ``CLASSES`` classes; with more of them, all are one class.
    """
    for steps in (16, 4, 1):
        low = _step(F.coalesce("min_ps", F.lit(0.0)), steps, -_ALL)
        high = F.when(F.col("max_ps").isNull(), F.lit(_ALL)).otherwise(_step(F.col("max_ps"), steps, -_ALL))
        ranges = items.select(low.alias("low"), high.alias("high")).distinct().limit(CLASSES + 1).collect()
        if len(ranges) <= CLASSES:
            break
    else:
        return items.withColumn("_class", F.lit(0)), requests.withColumn("_class", F.lit(0))
    ranges = sorted(map(tuple, ranges))
    own = F.lit(None).cast("int")
    for k, (a, b) in enumerate(ranges):
        own = F.when((low == a) & (high == b), F.lit(k)).otherwise(own)
    at = F.when(F.col("cell").isNotNull(), _step(F.col("cell"), steps, -_ALL))
    admitted = F.array_compact(F.array(*[F.when((at >= a) & (at <= b), F.lit(k)) for k, (a, b) in enumerate(ranges)]))
    return items.withColumn("_class", own), requests.withColumn("_class", F.explode(admitted.cast("array<int>")))


def _first_meeting() -> Column:
    """Whether the parts of the world in which a pair met are the first in which its boxes overlap."""
    world = F.lit(WORLD)

    def interval(low: str, high: str, part: int) -> tuple[Column, Column]:
        if part == 0:
            return F.col(low), F.least(F.col(high), world)
        return F.when(F.col(high) > world, -world), F.col(high) - 2 * world

    def meet(item_part: int, request_part: int) -> Column:
        (a, b), (c, d) = interval("x_min", "x_max", item_part), interval("rx_min", "rx_max", request_part)
        return F.coalesce((a < d) & (c < b), F.lit(False))

    turn = F.col("_part") * 2 + F.col("_rpart")
    return (turn == 0) | ~(meet(0, 0) | ((turn > 1) & meet(0, 1)) | ((turn > 2) & meet(1, 0)))


def select_items(items: DataFrame, requests: DataFrame, by_time: bool = False) -> DataFrame:
    """Pairs of a request and an item that it shows: space, pixel size, and time.

    Requests carry ``rx_min … ry_max``, ``cell``, ``t_from`` and ``t_to``; a null time
    on both sides means that time is not asked for, on one side that it is open there. Items without dates pass only such requests.
    Boxes are in web mercator; one whose ``x_max`` exceeds the world's edge goes on at the other.

    A request meets only items whose pixel-size range may admit its cell, so a zoomed-out one meets the overviews
    and none of the scenes under them.

    ``by_time`` parts the join by dates too. It pays where many requests meet many scenes
    of one place, as each scene then meets the requests of its days only; elsewhere the
    extra rows per scene cost more.

    Requests are read more than once; give it stored ones.
    """
    item_times, request_times = (("start_date", "end_date"), ("t_from", "t_to")) if by_time else ((), ())
    items = staged(world_parts(items).sortWithinPartitions("_part_min", "y_min"), "items")
    items, asked = with_resolution_class(items, world_parts(requests, "rx_min", "rx_max", "_rpart"))
    pairs = join_boxes(
        items,
        asked,
        Box("_part_min", "y_min", "_part_max", "y_max", *item_times),
        Box("_rpart_min", "ry_min", "_rpart_max", "ry_max", *request_times),
        on="_class",
        stored=(True, True),
    )
    pairs = pairs.where(visible_at(F.col("cell")) & in_time() & _first_meeting())
    return pairs.drop("_class", *(f"{p}{end}" for p in ("_part", "_rpart") for end in ("", "_min", "_max")))


# -- orders: values that rise from the leading item on, nulls last; the name makes them total --


def by_attribute(field: str = "start_date", base: str = ORDER_BASE) -> list[Column]:
    """Distance of a date to the base, nearest first: the newest item leads. Nulls last."""
    gap = F.abs(F.unix_micros(F.col(field).cast("timestamp")) - F.unix_micros(F.lit(base).cast("timestamp_ntz").cast("timestamp")))
    return [gap.isNull(), gap, F.col("name")]


def by_name() -> list[Column]:
    return [F.col("name")]


def by_center(x: Column, y: Column) -> list[Column]:
    """Squared distance of the item centre to the view centre."""
    dx, dy = F.col("center_x") - x, F.col("center_y") - y
    distance = dx * dx + dy * dy
    return [distance.isNull(), distance, F.col("name")]


def by_northwest(x_min: Column, y_max: Column) -> list[Column]:
    """Squared distance of the item centre to the north-west corner of the boundary."""
    return by_center(x_min, y_max)


def by_item_id(item: str = "item_id") -> list[Column]:
    """Catalog order."""
    return [F.col(item).isNull(), F.col(item), F.col("name")]


def lock_raster(items: DataFrame, locks: DataFrame) -> DataFrame:
    """Only the listed items of a request, placed by its list.

    ``locks`` has one row per listed name: ``request_id``, ``place`` and ``name``. The
    list is looked up by name, so no other item is touched.
    """
    return locks.join(items, "name").withColumn("mosaic_rank", F.col("place").cast("bigint")).drop("place")


def order_items(pairs: DataFrame, order: Sequence[Column], group: Sequence[str] = ("request_id",)) -> DataFrame:
    """Rank of every item of a request."""
    return ranked(pairs, group, order)


def order_selected(
    items: DataFrame, requests: DataFrame, order: Sequence[Column], rows_per_task: int = ROWS_PER_TASK, meetings: int = MEETINGS
) -> DataFrame:
    """``order_items(select_items(items, requests), order)`` where pairs are neither written nor moved.

    Each request has one home, a grid cell with the requests whose lower-left corners it holds. Items go to the homes whose
    requests they may meet, meet them there, and are numbered in the same task. A home with more than ``meetings``
    meetings deals its requests out to slices, each with all of its items. Items are written once, without their homes, and
    move once: the homes are few rows, which are looked up again instead. There are more tasks than slices, so that few
    tasks have to sort the pairs of several. Requests that name a place twice, cross the
    antimeridian, or whose home has more than ``rows_per_task`` items are taken pair by pair.
    """
    asked_box, item_box = Box("_rpart_min", "ry_min", "_rpart_max", "ry_max"), Box("_part_min", "y_min", "_part_max", "y_max")
    # rows of one place side by side take fewer bytes, stored and moved
    items, requests = staged(items.sortWithinPartitions("x_min", "y_min"), "items"), staged(requests, "requests")
    parts, asked = world_parts(items), world_parts(requests, "rx_min", "rx_max", "_rpart")
    sizes = sorted(map(tuple, parts.groupBy(native_level(item_box)).count().collect()))
    middle, seen = 0, 0
    for level, rows in sizes:
        middle, seen = (level, seen + rows) if 2 * seen <= sum(n for _, n in sizes) else (middle, seen)
    level = F.greatest(native_level(asked_box), F.lit(middle + 1))
    x, y = (F.floor(F.col(c).cast("double") / F.pow(F.lit(2.0), level)) for c in ("_rpart_min", "ry_min"))
    once = asked.groupBy("request_id").agg(F.count("*").alias("_n")).where("_n = 1 and request_id is not null").drop("_n")
    placed = asked.where(box_fault(asked_box).isNull()).withColumn("_home", F.concat_ws(" ", level, x, y)).join(once, "request_id", "left_semi")
    placed = staged(placed, "requests-at-home")
    homes = placed.groupBy("_home").agg(
        F.count("*").alias("_asked"), F.min("_rpart_min").alias("_hx0"), F.min("ry_min").alias("_hy0"),
        F.max("_rpart_max").alias("_hx1"), F.max("ry_max").alias("_hy1"),
    )
    # an item meets few homes
    sent = join_boxes(parts, homes, item_box, Box("_hx0", "_hy0", "_hx1", "_hy1"), stored=(True, False), many=HOMES_EACH)
    sent = sent.drop("_hx0", "_hy0", "_hx1", "_hy1")
    met = sent.groupBy("_home").agg(F.count("*").alias("_items"), F.first("_asked").alias("_asked"))
    dealt = F.ceil(F.col("_items") * F.col("_asked") / F.lit(float(meetings))).cast("int")
    met = staged(met.withColumn("_slices", F.least(dealt, "_asked").cast("int")), "homes")
    total = met.where(F.col("_items") <= rows_per_task).agg(F.sum(F.col("_items") * F.col("_asked").cast("double"))).first()[0] or 0
    tasks = int(max(int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(TASKS_EACH * total / meetings, 20_000)))
    few = met.where(F.col("_items") <= rows_per_task).select("_home", "_slices")
    key = ["_home", "_slice"]
    here = join_measured(placed, few, ["_home"]).withColumn("_slice", F.pmod(F.xxhash64("request_id"), "_slices").cast("int"))
    there = join_measured(sent.drop("_asked"), few, ["_home"]).withColumn("_slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)))
    pairs = there.drop("_slices").repartition(tasks, *key).join(here.drop("_slices").repartition(tasks, *key).hint("merge"), key)
    pairs = pairs.where(overlap(item_box, asked_box) & visible_at(F.col("cell")) & in_time() & _first_meeting())
    number = F.row_number().over(Window.partitionBy("request_id", *key).orderBy(*order)).cast("bigint")
    helpers = [f"{p}{end}" for p in ("_part", "_rpart") for end in ("", "_min", "_max")]
    out = pairs.withColumn("mosaic_rank", number).drop(*key, *helpers)
    crowded = placed.join(met.where(F.col("_items") > rows_per_task), "_home", "left_semi").select("request_id")
    others = join_null_safe(requests, once.unionByName(crowded).groupBy("request_id").count().where("count = 1"), ["request_id"], "left_anti")
    others = staged(others, "other-requests")
    return out if others.isEmpty() else out.unionByName(order_items(select_items(items, others), order))


def cap_items(pairs: DataFrame, order: Sequence[Column], cap: int, group: Sequence[str] = ("request_id",)) -> DataFrame:
    """The leading ``cap`` items of a request, with their rank."""
    return first_n(pairs, group, order, cap)


def cap_met(
    items: DataFrame,
    requests: DataFrame,
    meet: Callable[[DataFrame, DataFrame], DataFrame],
    order: Sequence[Column],
    cap: int,
    group: Sequence[str] = ("request_id",),
    at_once: int = ALL_AT_ONCE,
) -> DataFrame:
    """The leading ``cap`` items that a request meets, with their rank, without meeting the items behind them.

    The same as ``cap_items(meet(items, requests), order, cap, group)``, for an ``order`` that follows from the items alone
    and a ``meet`` whose pairs keep all columns of both sides but those that it has no use for.
    Items are numbered in that order once. All requests meet the leading ones; a request that has ``cap`` of them is
    settled, and the others meet the next, longer stretch of items, until all are settled or no items are left.
    """
    items = staged(ranked(items.withColumn("_every", F.lit(1)), ["_every"], order, "_place").drop("_every"), "ordered-items")
    waiting, last = staged(requests, "requests"), items.count()
    low, high = 0, last if last * waiting.count() <= at_once else ROUND * cap
    found: list[DataFrame] = []
    while True:
        stretch = items.where((F.col("_place") > low) & (F.col("_place") <= high))
        found.append(staged(cap_items(meet(stretch, waiting), [F.col("_place")], cap, group), "leading-items"))
        if high >= last:
            break
        held = reduce(DataFrame.unionByName, found).groupBy(*group).agg(F.count("*").alias("_held"))
        waiting = staged(join_null_safe(waiting, held.where(F.col("_held") >= cap), group, "left_anti"), "requests")
        if waiting.isEmpty():
            break
        low, high = high, high * WIDER
    if len(found) == 1:
        return found[0].drop("_place")
    return cap_items(reduce(DataFrame.unionByName, found), [F.col("_place")], cap, group).drop("_place")


def first_merge(pixels: DataFrame, cells: Sequence[str], value: str = "v", rank: str = "mosaic_rank") -> DataFrame:
    """FIRST: per output cell the valid value of the leading item.

    A hash aggregate on fixed-width buffers: pixels are combined before the shuffle,
    and at most one row per cell and task moves.
    """
    return (
        pixels.where(F.col(value).isNotNull())
        .groupBy(*cells)
        .agg(
            F.min_by(value, rank).alias(value),
            F.min(rank).alias(rank),
            F.count("*").alias("n_candidates"),
        )
    )
