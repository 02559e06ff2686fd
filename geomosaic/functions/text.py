"""Text templates, template lists and the time-window document."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FIELD = re.compile(r"\{\{\s*(\w+)\s*\}\}")


def render(template: str, fields: Mapping[str, Column]) -> Column:
    """Fill ``{{field}}`` marks with columns. An undefined field is an error at once."""
    pieces: list[Column] = []
    at = 0
    for mark in _FIELD.finditer(template):
        if mark.group(1) not in fields:
            raise KeyError(f"template field {mark.group(1)!r} is undefined")
        pieces.append(F.lit(template[at : mark.start()]))
        pieces.append(fields[mark.group(1)].cast("string"))
        at = mark.end()
    pieces.append(F.lit(template[at:]))
    if "{{" in _FIELD.sub("", template):
        raise ValueError("template has an unfinished field")
    return F.concat(*pieces)


def template_list(names: Column, folder: str) -> Column:
    """Template paths joined by ``;`` and closed by ``None``."""
    paths = F.transform(names, lambda n: F.concat(F.lit(f"{folder}/"), n))
    return F.concat_ws(";", F.concat(paths, F.array(F.lit("None"))))


def default_template(name: Column, folder: str) -> Column:
    """Path of the default template; the word ``None`` passes through."""
    return F.when(name == "None", name).otherwise(F.concat(F.lit(f"{folder}/"), name))


def rewrite_window(df: DataFrame, doc: str, schema: str, end_ms: Column, start_ms: Column, extent_ms: Column) -> DataFrame:
    """Set the four time members of a window document, and leave the rest as it is.

    The document is parsed and written once per row; ``schema`` says what it may hold.
    """
    parsed = df.withColumn("_doc", F.from_json(doc, schema))
    properties = (
        F.col("_doc.widgets.timeSlider.properties")
        .withField("endTime", end_ms)
        .withField("startTime", start_ms)
        .withField("currentTimeExtent", F.array(extent_ms, end_ms))
        .withField(
            "timeStopInterval",
            F.struct(F.lit(1).alias("interval"), F.lit("esriTimeUnitsDays").alias("units")),
        )
    )
    new = F.col("_doc").withField("widgets.timeSlider.properties", properties)
    return parsed.withColumn(doc, F.to_json(new)).drop("_doc")
