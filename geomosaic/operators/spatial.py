"""Extent joins: rows whose boxes overlap, by equi-joins on grids of several cell sizes.

Cell sizes are powers of two. Every box gets a native level, whose cell is one to two
times its own size. A pair meets at the coarser of its two native levels only, and only in
the cell that holds the lower-left corner of one side's box. That side has one row there; the
other, whose rows are fewer bytes, has one for each cell in which such a corner can lie, nine
at most. So the result needs no ``distinct``, long rows are not repeated, a large overview costs
a few rows and not thousands, and a crowd of small boxes is parted by small cells: the
pairs looked at stay within a constant factor of the pairs that overlap, as long as
boxes are not much longer than they are wide.

Boxes may have a time span too. It has levels of its own, so the many scenes that lie on
one spot, one per overpass, are parted by their dates.

A cell whose two sides would meet too often is cut into rectangles of rows, each of which meets at
most a set number of times, however long either side is. That number grows with all meetings, so that
there are no more rectangles than ``MOST_CUT`` and rows are not repeated more often as tables grow.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomosaic.operators.bounded import fits_broadcast
from geomosaic.session import staged

#: Meetings of the two sides of one cell that one task takes at most.
MEETINGS = 16_000_000
#: Meetings for each row of both sides from which on they are dealt to tasks by their number; tasks at most.
MANY_EACH, MOST_TASKS = 8, 20_000
#: Rectangles of about the set number of meetings; with more meetings in all, each takes more.
MOST_CUT = 1024
MIN_LEVEL, MAX_LEVEL = -30, 1023
# time levels are powers of two of a microsecond; at the open level all times are one cell
MIN_TIME_LEVEL, MAX_TIME_LEVEL, OPEN_TIME_LEVEL = 20, 61, 62


@dataclass(frozen=True)
class Box:
    """Names of the extent columns of a side, and of its time columns if it has any."""

    x_min: str = "x_min"
    y_min: str = "y_min"
    x_max: str = "x_max"
    y_max: str = "y_max"
    t_min: str | None = None
    t_max: str | None = None

    def columns(self) -> list[Column]:
        return [F.col(c).cast("double") for c in (self.x_min, self.y_min, self.x_max, self.y_max)]

    def times(self) -> list[Column]:
        """Start and end in microseconds."""
        return [F.unix_micros(F.col(c).cast("timestamp")) for c in (self.t_min, self.t_max)]

    @property
    def timed(self) -> bool:
        return self.t_min is not None and self.t_max is not None


def native_level(box: Box) -> Column:
    """Power of two of the cell size that suits a box; a point has the finest one."""
    x0, y0, x1, y1 = box.columns()
    size = F.greatest(x1 - x0, y1 - y0)
    return F.when(size > 0, _fitting(size, MIN_LEVEL, MAX_LEVEL)).otherwise(F.lit(MIN_LEVEL)).cast("int")


def _fitting(size: Column, least: int, most: int) -> Column:
    """The first level whose cell is not smaller than ``size``; the logarithm may be rounded down."""
    level = F.ceil(F.log2(size))
    level = level + (F.pow(F.lit(2.0), level) < size).cast("int")
    return F.greatest(F.lit(least), F.least(level, F.lit(most)))


def native_time_level(box: Box) -> Column:
    """The same for the time span; a side without times is open."""
    if not box.timed:
        return F.lit(OPEN_TIME_LEVEL)
    start, end = box.times()
    size = end - start
    fitting = _fitting(size, MIN_TIME_LEVEL, MAX_TIME_LEVEL)
    return (
        F.when(size.isNull(), F.lit(OPEN_TIME_LEVEL)).when(size > 0, fitting).otherwise(F.lit(MIN_TIME_LEVEL)).cast("int")
    )


# the keys that tell most rows apart come first, which sorts them cheaply
_CELL, _TIME_CELL = ["_cx", "_cy", "_level"], ["_ct", "_time"]


def box_fault(box: Box) -> Column:
    """What keeps a box from any overlap: ``null``, ``infinite`` (or not a number) or ``inverted``; null for a proper box."""
    x0, y0, x1, y1 = sides = box.columns()
    lacking, endless = F.lit(False), F.lit(False)
    for side in sides:
        lacking = lacking | side.isNull()
        endless = endless | F.isnan(side) | (F.abs(side) == float("inf"))
    inverted = (x0 > x1) | (y0 > y1)
    return F.when(lacking, F.lit("null")).when(endless, F.lit("infinite")).when(inverted, F.lit("inverted"))


def rejected_boxes(df: DataFrame, box: Box) -> DataFrame:
    """The rows that no extent join can place, with the ``reject_reason``."""
    return df.withColumn("reject_reason", box_fault(box)).where(F.col("reject_reason").isNotNull())


def _levels(left: DataFrame, right: DataFrame, on: list[str]) -> list:
    """Row counts and bytes per key and native level of both sides: a few hundred small rows at most."""
    sides = [
        df.select(
            F.lit(side).alias("side"), *on, F.col(f"_{side}_own").alias("own"), F.col(f"_{side}_time").alias("time"), _bytes(df).alias("bytes")
        )
        for side, df in (("l", left), ("r", right))
    ]
    counted = sides[0].unionByName(sides[1]).groupBy("side", *on, "own", "time")
    return counted.agg(F.count("*").alias("count"), F.sum("bytes").alias("bytes")).collect()


def _bytes(df: DataFrame) -> Column:
    """About the bytes of a row, by its texts and the lengths of its arrays."""
    long = {"string": F.octet_length, "binary": F.octet_length, "array": lambda name: F.size(name) * 8}
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    lengths = [F.coalesce(long[kind](name), F.lit(0)) for name, kind in kinds.items() if kind in long]
    return sum(lengths, F.lit(8 * len(kinds))).cast("double")


def _with_partners(df: DataFrame, partners: list, on: list[str]) -> DataFrame:
    """``df`` with the levels of the rows it can meet, as sorted arrays; null for a key without partners."""

    def arrays(rows: list) -> tuple[list[int], list[int]]:
        return sorted({r["own"] for r in rows}), sorted({r["time"] for r in rows})

    def of_key(place: int) -> Column:
        if not on:
            return F.array(*map(F.lit, arrays(partners)[place])).cast("array<int>")
        keys = sorted({r[on[0]] for r in partners})
        lists = [(F.lit(k), F.array(*map(F.lit, arrays([r for r in partners if r[on[0]] == k])[place]))) for k in keys]
        known = F.create_map(*[c for pair in lists for c in pair]) if lists else F.create_map().cast("map<int,array<int>>")
        return F.element_at(known, F.col(on[0]))

    return df.withColumns({"_partners": of_key(0), "_partner_times": of_key(1)})


def _meeting_levels(own: Column, partners: Column) -> Column:
    """Where a row can meet partners: at its own level, if some partner is as fine, and
    at the partners' coarser levels."""
    at_own = F.when(own >= F.array_min(partners), F.array(own)).otherwise(F.array().cast("array<int>"))
    return F.concat(at_own, F.filter(partners, lambda p: p > own))


def _place(df: DataFrame, box: Box, side: str, partners: list, on: list[str], corner: bool | None = None) -> DataFrame:
    """One row per cell of a row, at each level where it can meet a partner, and its ``_at``.

    On the ``corner`` side (the left, if not told) a row is in the cell of its lower-left corner, and of its start. On the
    other it is in all cells that can hold the corner of a partner: from its own corner less the size of the largest partner there on.

    A pair meets at the coarser of both levels. That is the one which is the own one of at least one side, of which
    ``_at`` holds a bit; another is for the level of the times.
    """
    corner = side == "l" if corner is None else corner
    x0, y0, x1, y1 = box.columns()
    cell = F.pow(F.lit(2.0), F.col("_level"))
    level_own, time_own = F.col(f"_{side}_own"), F.col(f"_{side}_time")
    reach = _reach(F.col("_level"), level_own, F.col("_partners"))

    def cells(low: Column, high: Column) -> Column:
        first, at = F.floor(low / cell), low / cell
        # exact where partners are as large as the cell; else less by more than what is lost in rounding
        wide = F.when(reach == MAX_LEVEL, F.lit(4)).otherwise(F.lit(1))
        narrow = F.floor(at - F.pow(F.lit(2.0), reach - F.col("_level")) * (1 + 2.0**-20) - F.abs(at) * 2.0**-50)
        return F.sequence(F.when(reach == F.col("_level"), first - wide).otherwise(F.least(first, narrow)), F.floor(high / cell))

    out = _with_partners(df, partners, on).withColumn("_level", F.explode(_meeting_levels(level_own, F.col("_partners"))))
    if corner:
        out = out.withColumns({"_cx": F.floor(x0 / cell), "_cy": F.floor(y0 / cell)})
    else:
        out = out.withColumn("_cx", F.explode(cells(x0, x1))).withColumn("_cy", F.explode(cells(y0, y1)))
    own = [F.col("_level") == level_own]
    if box.timed:
        start, end = F.col(f"_{side}_start"), F.col(f"_{side}_end")
        is_open = F.col("_time") == OPEN_TIME_LEVEL
        out = out.withColumn("_time", F.explode(_meeting_levels(time_own, F.col("_partner_times"))))
        if corner:
            out = out.withColumn("_ct", F.when(is_open, F.lit(0).cast("bigint")).otherwise(_time_cell(start)))
        else:
            longest = F.call_function("shiftleft", F.lit(1).cast("bigint"), _reach(F.col("_time"), time_own, F.col("_partner_times")))
            span = _time_cell(start - longest), F.greatest(_time_cell(start - longest), _time_cell(end))
            spread = F.when(is_open, F.array(F.lit(0).cast("bigint"))).otherwise(F.sequence(*span))
            out = out.withColumn("_ct", F.explode(spread))
        own.append(F.col("_time") == time_own)
    bits = sum((F.when(is_own, F.lit(1 << k)).otherwise(F.lit(0)) for k, is_own in enumerate(own)), F.lit(0))
    return out.withColumn(f"_{side}_at", bits).drop("_partners", "_partner_times", f"_{side}_own", f"_{side}_time")


def _reach(level: Column, own: Column, partners: Column) -> Column:
    """The coarsest own level of the partners that a row meets at a level."""
    return F.when(level > own, level).otherwise(F.array_max(F.filter(partners, lambda p: p <= level)))


def _time_cell(when: Column) -> Column:
    return F.call_function("shiftright", when, F.col("_time"))


def cell_rows(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """The cells in which both sides have rows, with the rows of each."""
    counted = (
        left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r"))
        .unionByName(right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r")))
        .groupBy(*keys)
        .agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    )
    return counted.where("l > 0 and r > 0")


def hot_cells(left: DataFrame, right: DataFrame, keys: list[str], meetings: int = MEETINGS) -> DataFrame:
    """The cells with more than ``meetings`` pairs, with the number of slices each side is cut into."""
    return slices_of(cell_rows(left, right, keys), keys, meetings)


def slices_of(counted: DataFrame, keys: list[str], meetings: int, heavier: float = 1.0) -> DataFrame:
    """The same from ``cell_rows``, where a row of the left side is ``heavier`` times the bytes of one of the right.

    Slices are about as many bytes on both sides, so that few are repeated; a side shorter than that stays whole.
    """
    counted = counted.where(F.col("l").cast("double") * F.col("r") > meetings)

    def slices(own: str, other: str, weight: float) -> Column:
        longest = F.lit(float(max(1, int((meetings * weight) ** 0.5))))
        return F.ceil(F.col(own) * F.least(F.col(other).cast("double"), longest) / F.lit(float(meetings))).cast("int")

    return counted.select(*keys, slices("l", "r", heavier).alias("_nl"), slices("r", "l", 1 / heavier).alias("_nr"))


def _slice(df: DataFrame, hot: DataFrame, keys: list[str], own: str, other: str, own_slice: str, other_slice: str) -> DataFrame:
    """Give each row of a hot cell one slice of its own side and all of the other's.

    The slice follows from the place of the row in its stored table, so a task that runs again gives the
    same slices, and equal rows are dealt out too.
    """
    tagged = df.join(hot, keys, "left")
    own_n, other_n = F.coalesce(own, F.lit(1)), F.coalesce(other, F.lit(1))
    return (
        tagged.withColumn(own_slice, F.pmod(F.xxhash64("_row"), own_n).cast("int"))
        .withColumn(other_slice, F.explode(F.sequence(F.lit(0), other_n - F.lit(1))))
        .drop("_nl", "_nr")
    )


def join_boxes(
    left: DataFrame,
    right: DataFrame,
    left_box: Box,
    right_box: Box,
    half_open: bool = False,
    meetings: int = MEETINGS,
    on: str | None = None,
    stored: tuple[bool, bool] = (False, False),
    many: int = MANY_EACH,
) -> DataFrame:
    """All pairs of rows whose boxes overlap with a positive area.

    With ``half_open`` the right side holds points: a point belongs to a box when
    ``min <= p < max``. If both boxes name time columns, their closed spans must share a
    moment; a row that lacks one of its times is open and fits every span. Column names
    of the two sides must differ, but for ``on``: an integer column of both sides with few values, in which the rows of a pair agree.

    Rows without a proper box meet nothing; ``rejected_boxes`` tells them with a reason. Each side is evaluated once
    and written; ``stored`` says of a side that it is a stored table, at most filtered and projected, which is read again instead.
    From ``many`` meetings for each row on, the rows of both sides are dealt to tasks by the number of meetings.
    """
    if left_box.timed != right_box.timed:
        raise ValueError("either both sides have times or none has")
    keyed = [on] if on else []
    left, right = (
        _fixed(df.where(box_fault(box).isNull()), box, side, is_stored)
        for df, box, side, is_stored in ((left, left_box, "l", stored[0]), (right, right_box, "r", stored[1]))
    )
    found = _levels(left, right, keyed)
    l_levels, r_levels = ([row for row in found if row["side"] == side] for side in "lr")
    # the side that is fewer bytes has several rows of each
    l_bytes, r_bytes = (sum(row["bytes"] for row in side) for side in (l_levels, r_levels))
    l_corner = l_bytes >= r_bytes
    # a row is in a cell once, so fewer rows than this have no hot cell
    l_rows, r_rows = (sum(row["count"] for row in side) for side in (l_levels, r_levels))
    if l_rows * r_rows > meetings:
        left, right = (left, _spread_out(right)) if l_corner else (_spread_out(left), right)
    l_cells = _place(left, left_box, "l", r_levels, keyed, l_corner)
    r_cells = _place(right, right_box, "r", l_levels, keyed, not l_corner)
    cell = [*_CELL, *(_TIME_CELL if left_box.timed else [])]
    keys, cut, tasks = [*cell, *keyed], [], 0
    if l_rows * r_rows > meetings:
        # known before the rows move, so that they move once, to their slice
        counted = staged(cell_rows(l_cells, r_cells, keys), "cell-rows")
        total = counted.agg(F.sum(F.col("l").cast("double") * F.col("r"))).first()[0] or 0
        meetings = max(meetings, int(total / MOST_CUT))
        if total > many * (l_rows + r_rows):
            least = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            tasks = max(least, int(min(total / meetings, MOST_TASKS)))
        hot = slices_of(counted, keys, meetings, (l_bytes / l_rows) / (r_bytes / r_rows))
        if not hot.isEmpty():
            hot = F.broadcast(hot) if fits_broadcast(hot) else hot
            l_cells = _slice(l_cells, hot, keys, "_nl", "_nr", "_sl", "_sr")
            r_cells = _slice(r_cells, hot, keys, "_nr", "_nl", "_sr", "_sl")
            cut = ["_sl", "_sr"]
    l_cells, r_cells, keys = l_cells.drop("_row"), r_cells.drop("_row"), [*keys, *cut]
    if tasks:
        # as many tasks as the meetings ask for, however few the files of a side are
        l_cells, r_cells = l_cells.repartition(tasks, *keys), r_cells.repartition(tasks, *keys).hint("merge")
    # cheap comparisons first: this is looked at once per candidate pair
    here = F.col("_l_at").bitwiseOR(F.col("_r_at")) == F.lit(3 if left_box.timed else 1)
    shared = overlap(left_box, right_box, half_open)
    if left_box.timed:
        same_time = (F.col("_l_start") <= F.col("_r_end")) & (F.col("_r_start") <= F.col("_l_end"))
        shared = shared & ((F.col("_time") == OPEN_TIME_LEVEL) | same_time)
    helpers = [f"_{side}_{c}" for side in "lr" for c in ("at", "start", "end")]
    return l_cells.join(r_cells, keys).where(here & shared).drop(*cell, *cut, *helpers)


def _fixed(df: DataFrame, box: Box, side: str, is_stored: bool) -> DataFrame:
    """The side with its native levels, written unless it is stored already, and a number per row that stays."""
    placed = df.withColumns({f"_{side}_own": native_level(box), f"_{side}_time": native_time_level(box)})
    if box.timed:
        start, end = box.times()
        placed = placed.withColumns({f"_{side}_start": start, f"_{side}_end": end})
    # rows of one place side by side take fewer bytes, stored and moved
    placed = placed if is_stored else staged(placed.sortWithinPartitions(box.x_min, box.y_min), "boxes")
    return placed.withColumn("_row", F.monotonically_increasing_id())


def _spread_out(df: DataFrame) -> DataFrame:
    """A side of few files, of whose rows each becomes several, on all cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, "_row") if len(df.inputFiles()) < cores else df


def overlap(left: Box, right: Box, half_open: bool = False) -> Column:
    """Whether the boxes of a pair share an area."""
    lx0, ly0, lx1, ly1 = left.columns()
    rx0, ry0, rx1, ry1 = right.columns()
    if half_open:
        return (lx0 <= rx0) & (rx0 < lx1) & (ly0 <= ry0) & (ry0 < ly1)
    return (lx0 < rx1) & (rx0 < lx1) & (ly0 < ry1) & (ry0 < ly1)
