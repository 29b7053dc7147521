"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is an aggregate and a join on the node, so hubs are pre-aggregated before the
shuffle and their edges can be split by the skew join; nothing is collected but two
numbers per round. The edge table of each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.staging import staged


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """Link each node's neighbours (larger ones, or for the small star smaller ones and itself) to its least neighbour."""
    if small:
        pairs = edges
    else:
        pairs = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = pairs.groupBy(F.col("u").alias("m_u")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = pairs.join(least, pairs.u == least.m_u)
    if small:
        linked = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select(F.col("m_u").alias("u"), F.col("m").alias("v")))
    else:
        linked = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.where("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b) but those that are their component's least node.

    component is the smallest node reachable. Links of a node with itself are ignored;
    an empty table has no rows.
    """
    edges = staged(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    seen = None
    while True:
        edges = staged(_stars(_stars(edges, small=False), small=True), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen or now[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = now
