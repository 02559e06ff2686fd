"""Record queries: the items of a request as pages of bounded length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: records that one query returns at most.
MAX_RECORDS = 2000


def records(
    items: DataFrame,
    order: Sequence[str],
    fields: Sequence[str] | None = None,
    where: Column | str | None = None,
    box: Sequence[float] | None = None,
    time: tuple[object, object] | None = None,
    after: Sequence[object] | None = None,
    limit: int = MAX_RECORDS,
) -> DataFrame:
    """One page of the items that meet ``where``, overlap ``box`` (x_min, y_min, x_max, y_max) and share a moment with ``time``.

    ``order`` names columns, compared upwards with nulls first, that tell all items apart. ``after`` has their values in
    the last row of the page before (``last_key``); the next page begins behind it, so a page costs a bounded top-N of each task and
    never the pages before it. An end of ``time`` that is None is open; undated items meet only no ``time`` at all.
    """
    if not 0 < limit <= MAX_RECORDS:
        raise ValueError(f"a page has 1 to {MAX_RECORDS} records")
    found = items if where is None else items.where(where)
    if box is not None:
        x0, y0, x1, y1 = map(F.lit, box)
        found = found.where((F.col("x_min") < x1) & (F.col("x_max") > x0) & (F.col("y_min") < y1) & (F.col("y_max") > y0))
    if time is not None:
        low, high = time
        found = found.where(F.col("start_date").isNotNull() & F.col("end_date").isNotNull())
        found = found if low is None else found.where(F.col("end_date") >= _literal(found, "end_date", low))
        found = found if high is None else found.where(F.col("start_date") <= _literal(found, "start_date", high))
    if after is not None:
        found = found.where(_behind(found, order, after))
    page = found.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(limit)
    return page.select(*dict.fromkeys(fields)) if fields else page


def _literal(df: DataFrame, column: str, value: object) -> Column:
    return F.lit(value).cast(df.schema[column].dataType)


def _behind(df: DataFrame, order: Sequence[str], after: Sequence[object]) -> Column:
    """Rows behind a key; the first column is bounded by itself too, so that the scan can skip what lies before."""
    if len(order) != len(after):
        raise ValueError("after has a value for each column of the order")
    rows, key = (
        F.struct(*[c.alias(f"o{k}") for k, c in enumerate(side)])
        for side in ([F.col(c) for c in order], [_literal(df, c, v) for c, v in zip(order, after, strict=True)])
    )
    behind = rows > key
    return behind if after[0] is None else behind & (F.col(order[0]) >= _literal(df, order[0], after[0]))


def last_key(page: DataFrame, order: Sequence[str]) -> tuple | None:
    """The key of a page's last row, None of an empty page. The page must have the columns of ``order``."""
    last = page.agg(F.max(F.struct(*order)).alias("k")).first()["k"]
    return None if last is None else tuple(last)
