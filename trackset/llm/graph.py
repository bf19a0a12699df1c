"""Connected components of a link table by alternating large-star and small-star steps.

Every step is a few joins and pre-aggregated minima; nothing is gathered on the driver and no node's neighbours
are gathered in one task. Each round is written to the shared folder. Links with a null end count for nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def connected_components(links: DataFrame, a: str = "a", b: str = "b", rounds: int | None = None) -> DataFrame:
    """node, root (smallest node reachable) for every node of `links` but the roots themselves.

    `links` holds two long columns; repeated links, both directions and self-links are fine. After `rounds` rounds, if
    they are bounded, a root is some smaller node that is reachable: good enough to tell pairs that need no look.
    """
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()  # greatest() and least() pass over a null end, which makes a self-link
    edges = common.materialise(edges, "links")
    while rounds != 0 and not _is_stars(edges):
        rounds = None if rounds is None else rounds - 1
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        # minima are written, so that the joins exchange both sides and Spark can split a node of many links
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        low = common.materialise(low, "minima")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = common.materialise(large, "links")
        least = common.materialise(large.groupBy("a").agg(F.min("b").alias("m")), "minima")
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionAll(least.select("a", F.col("m").alias("b"))).distinct()
        done, edges = edges, common.materialise(small, "links")
        common.discard(done, low, large, least)
    if rounds is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))


def _is_stars(edges: DataFrame) -> bool:
    """Every node has one smaller neighbour at most, and that one has none."""
    ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("low")), F.struct(F.col("b").alias("node"), F.lit(0).alias("low"))))
    seen = edges.select(ends.alias("e")).groupBy("e.node").agg(F.sum("e.low").alias("low"), F.min("e.low").alias("is_low"))
    # a node with two smaller neighbours, or one that has a smaller and is somebody's smaller neighbour itself
    return seen.where("low > 1 OR low = 1 AND is_low = 0").isEmpty()
