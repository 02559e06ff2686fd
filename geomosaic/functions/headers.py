"""Raster header documents: schema, flattening, pixel types and EPSG codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEADER_SCHEMA = T.StructType(
    [
        T.StructField("description", T.StringType()),
        T.StructField(
            "cornerCoordinates",
            T.StructType(
                [
                    T.StructField("lowerLeft", T.ArrayType(T.DoubleType())),
                    T.StructField("upperRight", T.ArrayType(T.DoubleType())),
                ]
            ),
        ),
        T.StructField("size", T.ArrayType(T.IntegerType())),
        T.StructField("bands", T.ArrayType(T.StructType([T.StructField("type", T.StringType())]))),
        T.StructField("coordinateSystem", T.StructType([T.StructField("wkt", T.StringType())])),
    ]
)

# Pixel-type codes of the catalog.
PIXEL_TYPES = {"Byte": 3, "Int16": 6, "Float32": 9}


def pixel_type(band_type: Column, strict: bool = False) -> Column:
    """Code of a band type; an unknown one is null, or an error when strict."""
    code = F.lit(None).cast("int")
    if strict:
        code = F.raise_error(F.concat(F.lit("no pixel type for band type "), F.coalesce(band_type, F.lit("null")))).cast("int")
    for name, value in reversed(PIXEL_TYPES.items()):
        code = F.when(band_type == name, F.lit(value)).otherwise(code)
    return code


def root_epsg(wkt: Column) -> Column:
    """The authority code that closes a WKT text, as text; null when there is none."""
    return F.nullif(F.regexp_extract(wkt, r'AUTHORITY\["EPSG","(\d+)"\]\]\s*$', 1), F.lit(""))


def flatten(doc: Column, strict: bool = False) -> dict[str, Column]:
    """Core catalog columns of a header document. ``size`` is (columns, rows)."""
    low, high = doc["cornerCoordinates"]["lowerLeft"], doc["cornerCoordinates"]["upperRight"]
    return {
        "raster": doc["description"],
        "x_min": F.get(low, F.lit(0)),
        "y_min": F.get(low, F.lit(1)),
        "x_max": F.get(high, F.lit(0)),
        "y_max": F.get(high, F.lit(1)),
        "n_rows": F.get(doc["size"], F.lit(1)),
        "n_cols": F.get(doc["size"], F.lit(0)),
        "n_bands": F.size(doc["bands"]),
        "pixel_type": pixel_type(F.get(doc["bands"], F.lit(0))["type"], strict),
        "srs": root_epsg(doc["coordinateSystem"]["wkt"]),
    }
