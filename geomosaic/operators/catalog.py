"""Catalog operators: new rows, lookups, routing, overview records, field updates, order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geomosaic.functions import dates
from geomosaic.operators.bounded import join_measured

CATEGORY_OVERVIEW = 2

# Season name, code, label, short label, first and last day, place in the year.
SEASON_ROWS = """
    ('winter', 'DJF', 'December/January/February',   'Dec/Jan/Feb', DATE'2019-12-01', DATE'2020-02-29', 1),
    ('spring', 'MAM', 'March/April/May',             'Mar/Apr/May', DATE'2020-03-01', DATE'2020-05-31', 2),
    ('summer', 'JJA', 'June/July/August',            'Jun/Jul/Aug', DATE'2020-06-01', DATE'2020-08-31', 3),
    ('fall',   'SON', 'September/October/November',  'Sep/Oct/Nov', DATE'2020-09-01', DATE'2020-11-30', 4)
"""

# Family, largest source pixel size, smallest overview pixel size,
# overview cell size, items per mosaic.
FAMILIES = (
    ("RTC", 1610.0, 1600.0, 1200.0, 50),
    ("OPERA", 460.0, 450.0, 450.0, 75),
    ("COH", 910.0, 900.0, 900.0, 50),
    ("SAMPLE", 810.0, 800.0, 800.0, 50),
    ("HAND", 610.0, 600.0, 600.0, 50),
)
FAMILY_COLUMNS = ("family", "source_max_ps", "overview_min_ps", "overview_cell", "mosaic_cap")


def seasons(spark: SparkSession) -> DataFrame:
    """The season dimension: four rows."""
    return spark.sql(
        "SELECT * FROM VALUES "
        + SEASON_ROWS
        + " AS t(season_name, season_code, season, season_short, season_start, season_end, season_ordinal)"
    )


def family_rows() -> Column:
    """The family constants as an array of five structs."""
    return F.array(
        *[F.struct(*[F.lit(v).alias(n) for n, v in zip(FAMILY_COLUMNS, row, strict=True)]) for row in FAMILIES]
    )


def families(spark: SparkSession) -> DataFrame:
    """The family dimension: five rows."""
    return spark.range(1).select(F.inline(family_rows()))


def new_paths(listing: DataFrame, catalog: DataFrame, path: str = "path") -> DataFrame:
    """Listed paths that the catalog lacks, each once."""
    return listing.select(path).distinct().join(catalog.select(path), path, "left_anti")


def with_headers(paths: DataFrame, headers: DataFrame, path: str = "path") -> DataFrame:
    """Each path with its header document columns; ``has_header`` tells misses."""
    return paths.join(headers.withColumn("_found", F.lit(True)), path, "left").withColumn(
        "has_header", F.coalesce("_found", F.lit(False))
    ).drop("_found")


def with_every_season(df: DataFrame, strict: bool = True) -> DataFrame:
    """Lookup of ``season_name`` that keeps all rows; an unknown name is an error, or has null columns when lenient."""
    out = df.join(F.broadcast(seasons(df.sparkSession)), "season_name", "left")
    if strict:
        problem = F.concat(F.lit("unknown season name: "), F.coalesce("season_name", F.lit("null")))
        out = out.withColumn(
            "season_code", F.when(F.col("season_code").isNull(), F.raise_error(problem)).otherwise(F.col("season_code"))
        )
    return out


def with_season_code(df: DataFrame, strict: bool = True) -> DataFrame:
    """Lookup of ``season_code``; an unknown code is an error, or null when lenient."""
    out = df.join(F.broadcast(seasons(df.sparkSession)), "season_code", "left")
    if strict:
        problem = F.concat(F.lit("unknown season code: "), F.coalesce("season_code", F.lit("null")))
        out = out.withColumn(
            "season_name", F.when(F.col("season_name").isNull(), F.raise_error(problem)).otherwise(F.col("season_name"))
        )
    return out


def with_family(df: DataFrame) -> DataFrame:
    """Family constants by ``family`` from the five-row dimension."""
    return df.join(F.broadcast(families(df.sparkSession)), "family")


def route(objects: DataFrame, configs: DataFrame, key: str = "key") -> DataFrame:
    """Each object with every dataset whose prefix and suffix its key matches.

    Prefix and suffix become equality keys: a key is cut once per distinct pair of
    lengths among the configs, and the cuts are looked up. So any number of configs
    is served by a hash join, and no object is compared with every config.
    """
    lengths = [
        (row[0], row[1])
        for row in configs.select(F.length("s3_prefix"), F.length("s3_suffix")).distinct().collect()
        if row[0] is not None and row[1] is not None
    ]
    if not lengths:
        lengths = [(0, 0)]
    pairs = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(s).alias("s")) for p, s in sorted(lengths)])
    text = F.col(key)
    cut = (
        objects.withColumn("_len", F.explode(pairs))
        .where(F.length(text) >= F.greatest(F.col("_len.p"), F.col("_len.s")))
        .withColumn("_plen", F.col("_len.p"))
        .withColumn("_slen", F.col("_len.s"))
        .withColumn("_pre", F.left(text, F.col("_plen")))
        .withColumn("_suf", F.right(text, F.col("_slen")))
        .drop("_len")
    )
    lookup = configs.withColumns(
        {
            "_pre": F.col("s3_prefix"),
            "_suf": F.col("s3_suffix"),
            "_plen": F.length("s3_prefix"),
            "_slen": F.length("s3_suffix"),
        }
    )
    on = ["_pre", "_suf", "_plen", "_slen"]
    return join_measured(cut, lookup, on).drop(*on)


def union_catalog(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old rows and new rows by name; columns missing on one side are null."""
    return old.unionByName(new, allowMissingColumns=True)


def is_overview() -> Column:
    return F.coalesce(F.col("category") == CATEGORY_OVERVIEW, F.lit(False))


def source_items(items: DataFrame, tag: str = "tag") -> DataFrame:
    """Items without the freshly added overview, which is tagged ``Dataset``; an item without a tag is a source."""
    return items.where(~F.col(tag).eqNullSafe("Dataset"))


def append_overview(items: DataFrame, overviews: DataFrame) -> DataFrame:
    """Items plus the overview records."""
    return items.unionByName(overviews, allowMissingColumns=True)


def calculate_fields(df: DataFrame, fields: Mapping[str, Column | str], where: Column | None = None) -> DataFrame:
    """Set fields from SQL expressions or columns, for all rows or for a selection.

    All expressions see the row as it was before the update.
    """
    out: dict[str, Column] = {}
    for field, value in fields.items():
        new = F.expr(value) if isinstance(value, str) else value
        if where is not None:
            old = F.col(field) if field in df.columns else F.lit(None)
            new = F.when(where, new).otherwise(old)
        out[field] = new
    return df.withColumns(out)


def add_fields(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Add empty typed fields; a field that exists already is kept."""
    return df.withColumns({n: F.lit(None).cast(t) for n, t in fields.items() if n not in df.columns})


def transmit(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Project a transmission list; a field named twice is sent once."""
    return df.select(*dict.fromkeys(fields))


def guard_prefix(df: DataFrame, prefix: str, path: str = "path", strict: bool = True) -> DataFrame:
    """Paths outside the family's bucket are an error, or flagged in ``reject_reason``."""
    good = F.col(path).startswith(prefix)
    if strict:
        problem = F.concat(F.lit("path outside the bucket: "), F.coalesce(F.col(path), F.lit("null")))
        return df.withColumn(path, F.when(good, F.col(path)).otherwise(F.raise_error(problem)))
    return df.withColumn("reject_reason", F.when(~F.coalesce(good, F.lit(False)), F.lit("bucket")))


def expired(objects: DataFrame, suffixes: Sequence[str], as_of: Column, minutes: int = 10_800) -> DataFrame:
    """Run outputs with one of the suffixes, older than the retention time. Lists only."""
    wanted = F.lit(False)
    for suffix in suffixes:
        wanted = wanted | F.col("name").endswith(suffix)
    return objects.where(wanted & (F.col("mtime") < as_of - F.expr(f"interval {minutes} minutes")))


def repair_paths(items: DataFrame, roots: Mapping[str, str], path: str = "path") -> DataFrame:
    """Replace an old path root by its new one; the longest matching root wins."""
    fixed = F.col(path)
    for old in sorted(roots, key=len):
        moved = F.concat(F.lit(roots[old]), F.col(path).substr(F.lit(len(old) + 1), F.length(path)))
        fixed = F.when(F.col(path).startswith(old), moved).otherwise(fixed)
    return items.withColumn(path, fixed)


def overview_records(items: DataFrame, names: Column) -> DataFrame:
    """One overview record per dataset: its extent, its time range and one of its tags.

    The time range spans the first to the last start date, eight hours wider each way.
    """
    return (
        items.groupBy("dataset")
        .agg(
            F.min("x_min").alias("x_min"),
            F.min("y_min").alias("y_min"),
            F.max("x_max").alias("x_max"),
            F.max("y_max").alias("y_max"),
            dates.overview_start(F.min("start_date")).alias("start_date"),
            dates.overview_end(F.max("start_date")).alias("end_date"),
            F.min("tag").alias("_tag"),
        )
        .withColumn("name", names)
        .withColumn("category", F.lit(CATEGORY_OVERVIEW))
    )
