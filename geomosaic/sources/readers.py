"""Scans. Every reader takes a path or a landed table and returns a DataFrame."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomosaic.functions import names
from geomosaic.functions.headers import HEADER_SCHEMA

GRANULE_PAGE_SCHEMA = "pol string, items array<struct<umm: struct<RelatedUrls: array<struct<URL: string>>>>>"

CONFIG_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "project_name",
            "raster_store",
            "bucket",
            "overview_path",
            "s3_prefix",
            "s3_suffix",
            "opera_version",
            "dataset_name",
        )
    ]
    + [
        T.StructField("raster_function_templates", T.ArrayType(T.StringType())),
        T.StructField("default_raster_function_template", T.StringType()),
        T.StructField("service_folder", T.StringType()),
        T.StructField("service_name", T.StringType()),
        T.StructField("service_definition_overrides", T.MapType(T.StringType(), T.StringType())),
    ]
)


def list_files(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """Objects below a folder, by metadata only: contents are never read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{suffix}")
        .load(root)
        .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))
    )


def list_objects(inventory: DataFrame, prefix: str, suffix: str) -> DataFrame:
    """Objects of a landed inventory by key prefix and suffix, with their paths."""
    kept = inventory.where(F.col("key").startswith(prefix) & F.col("key").endswith(suffix))
    return kept.withColumn("path", names.vsi_path(F.col("bucket"), F.col("key")))


def list_matching(inventory: DataFrame, pattern: str = names.HAND_PATTERN) -> DataFrame:
    """Objects whose whole path matches a pattern."""
    return inventory.where(F.col("path").rlike(f"^(?:{pattern})$"))


def read_path_list(spark: SparkSession, path: str) -> DataFrame:
    """A file of one path per line; all lines are kept, blank ones are not paths."""
    return spark.read.text(path).select(F.col("value").alias("path")).where(F.length("path") > 0)


def read_search_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed search pages, one JSON document per line."""
    return spark.read.schema(GRANULE_PAGE_SCHEMA).json(path)


def first_url(urls: Column, polarization: Column) -> Column:
    """The first related URL in the object store that ends with the polarization."""
    fits = F.filter(
        urls, lambda u: u["URL"].startswith("s3://") & u["URL"].endswith(F.concat(polarization, F.lit(".tif")))
    )
    return names.s3_to_vsi(F.get(fits, F.lit(0))["URL"])


def granule_paths(pages: DataFrame) -> DataFrame:
    """One path per granule of the pages; granules without a fitting URL are left out."""
    granules = pages.select("pol", F.explode("items").alias("granule"))
    return granules.select(
        "pol", first_url(F.col("granule.umm.RelatedUrls"), F.col("pol")).alias("path")
    ).where(F.col("path").isNotNull())


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """Landed header documents, one per line, as a ``header`` struct keyed by ``path``."""
    docs = spark.read.schema(HEADER_SCHEMA).json(path)
    return docs.select(F.col("description").alias("path"), F.struct("*").alias("header"))


def parse_headers(docs: DataFrame, text: str = "doc") -> DataFrame:
    """Header documents held as text in a column."""
    return docs.withColumn("header", F.from_json(text, HEADER_SCHEMA))


def read_catalog_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A catalog file, all text; empty when there is none yet."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    try:
        return spark.read.schema(schema).option("header", True).csv(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_configs(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Service configs, with the override map; one document per file or per line."""
    return spark.read.schema(CONFIG_SCHEMA).option("multiLine", multi_line).json(path)


def items_from_catalog(catalog: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text catalog rows to typed items with centres; a bad number becomes null."""
    typed = catalog.select(*[F.col(c).try_cast(t).alias(c) for c, t in types.items()])
    return typed.withColumns(
        {
            "center_x": (F.col("x_min") + F.col("x_max")) / 2,
            "center_y": (F.col("y_min") + F.col("y_max")) / 2,
        }
    )
