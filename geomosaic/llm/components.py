"""Connected components of a link table by alternating large-star and small-star steps.

Each step is a grouped minimum, combined before the shuffle, and a join on the node, so a hub
with many links is never gathered in one place. Steps are written to the shared folder; a
lost executor repeats one step only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomosaic.llm.common import staged


def components(links: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """One row (node, component) per node of ``links`` (a, b); component is its smallest node.

    Repeated, reversed and self links do no harm; links with a null end are left out. With ``rows_per_task``
    a step is written by one task per so many edges, so a small table is not cut into many files.
    """
    a, b = F.col("a"), F.col("b")
    edges = staged(
        links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links"
    )
    seen = None
    while (state := edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()) != seen:
        seen = state
        step = _small_star(_large_star(edges))
        edges = staged(step.coalesce(1 + state[0] // rows_per_task) if rows_per_task else step, "links")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour or itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.where(F.col("v") > F.col("u")).join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    pairs = F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
    return joined.select(pairs.alias("e")).select("e.u", "e.v").where("u != v").distinct()
