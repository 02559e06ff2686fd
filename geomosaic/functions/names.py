"""Paths and product-name grammars as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COMPACT_TIME = "yyyyMMdd'T'HHmmss"
CATALOG_TIME = "MM/dd/yyyy HH:mm:ss"
CATALOG_DATE = "MM/dd/yyyy"

# File-name grammar of the elevation-drainage tiles, without the 90-degree rows.
HAND_PATTERN = r".*Copernicus_DSM_COG_10_[NS][0-8]\d_00_[EW]\d\d\d_00_HAND.tif"
# Labels of the elevation-drainage family.
HAND_TAG = "GLO30_HAND"
HAND_DATASET_ID = "Global_30m_HAND"


def stem(path: Column) -> Column:
    """Last path part without its last extension."""
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def vsi_path(bucket: Column, key: Column) -> Column:
    return F.concat(F.lit("/vsis3/"), bucket, F.lit("/"), key)


def s3_to_vsi(url: Column) -> Column:
    return F.regexp_replace(url, "^s3://", "/vsis3/")


def vsi_to_s3(path: Column) -> Column:
    return F.regexp_replace(path, "^/vsis3/", "s3://")


def strip_prefix(path: Column, prefix: Column) -> Column:
    """Drop as many leading characters as the prefix has, whether or not they match."""
    return F.substring(path, F.length(prefix) + F.lit(1), F.length(path))


def token(name: Column, index: int) -> Column:
    """Token ``index`` (0-based) of an underscore name; null when it has fewer."""
    return F.get(F.split(name, "_"), F.lit(index))


def compact_time(text: Column) -> Column:
    """``20240101T000007`` to a zone-free timestamp; null when malformed."""
    return F.try_to_timestamp(text, F.lit(COMPACT_TIME)).cast("timestamp_ntz")


def catalog_time(text: Column) -> Column:
    """``MM/DD/YYYY HH:MM:SS`` to a zone-free timestamp; null when malformed."""
    return F.try_to_timestamp(text, F.lit(CATALOG_TIME)).cast("timestamp_ntz")


def catalog_text(when: Column) -> Column:
    """Timestamp to ``MM/DD/YYYY HH:MM:SS``."""
    return F.date_format(when, CATALOG_TIME)


def rtc_fields(name: Column, url_base: Column) -> dict[str, Column]:
    """Attributes in a terrain-corrected scene name: token 2 is the time, token 8 the tag."""
    start = compact_time(token(name, 2))
    return {
        "tag": token(name, 8),
        "group_name": F.substring(name, 1, 46),
        "start_date": start,
        "end_date": start,
        "download_url": F.concat(url_base, name, F.lit(".tif")),
    }


def opera_fields(name: Column, version: str, url_base: Column) -> dict[str, Column]:
    """Attributes in a burst-product name: the time sits at offsets 32 to 47."""
    parts = F.split(name, "_")
    start = compact_time(F.substring(name, 33, 15))
    polarization = F.get(parts, F.lit(9))
    return {
        "tag": F.when(
            polarization.isNotNull(),
            F.concat_ws("_", F.slice(parts, 1, 3), F.lit(version), polarization),
        ),
        "group_name": F.regexp_replace(name, "_[^_]*$", ""),
        "polarization": polarization,
        "start_date": start,
        "end_date": start,
        "download_url": F.concat(url_base, name, F.lit(".tif")),
        "url_display": name,
    }


def coh_fields(name: Column) -> dict[str, Column]:
    """Attributes in a seasonal coherence name of exactly four tokens; else all null."""
    parts = F.split(name, "_")
    exact = F.size(parts) == 4

    def part(i: int) -> Column:
        return F.when(exact, F.get(parts, F.lit(i)))

    return {
        "tile": part(0),
        "season_name": part(1),
        "polarization": F.upper(part(2)),
        "product_type": part(3),
    }


def coh_tag(product: Column, polarization: Column, season_code: Column) -> Column:
    return F.concat(product, F.lit("_"), polarization, F.lit("_"), season_code)


def hand_fields(name: Column, url_base: Column) -> dict[str, Column]:
    """Attributes in an elevation-drainage tile name: tokens 4 and 6 give the tile."""
    tile = F.concat(token(name, 4), token(name, 6))
    label = F.concat(F.lit(f"{HAND_TAG}_"), tile)
    return {
        "tile": tile,
        "tag": F.lit(HAND_TAG),
        "dataset_id": F.lit(HAND_DATASET_ID),
        "product_name": label,
        "url_display": label,
        "download_url": F.concat(url_base, name, F.lit(".tif")),
    }


def overview_parts(name: Column) -> dict[str, Column]:
    """Product, polarization and season code in a seven-token overview name; else null."""
    parts = F.split(name, "_")
    exact = F.size(parts) == 7

    def part(i: int) -> Column:
        return F.when(exact, F.get(parts, F.lit(i)))

    return {"product_type": part(1), "polarization": part(2), "season_code": part(3)}


def suffix_polarization(suffix: Column) -> Column:
    """``_VV.tif`` to ``VV``."""
    return F.substring(suffix, 2, 2)


def product_interval(product: Column) -> Column:
    """``COH06`` to 6."""
    return F.right(product, F.lit(2)).try_cast("int")


def polarization_class(pol: Column) -> Column:
    """Which backscatter note applies; empty for a polarization with no note."""
    first, second = F.substring(pol, 1, 1), F.substring(pol, 2, 1)
    return (
        F.when(first != second, F.lit("cross-polarized: volume scattering"))
        .when(first == "V", F.lit("co-polarized: surface roughness and soil moisture"))
        .when(first == "H", F.lit("co-polarized: double-bounce scattering"))
        .otherwise(F.lit(""))
    )


def run_name(project: Column, dataset: Column, as_of: Column) -> Column:
    """``{project}_{dataset}_{yymmdd_HHMM}`` of a run, from an explicit as-of time in UTC."""
    return F.concat_ws("_", project, dataset, F.date_format(as_of, "yyMMdd_HHmm"))
