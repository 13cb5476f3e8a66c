"""Connected components of a large graph, without collecting it anywhere.

Alternating large-star and small-star steps: each links the neighbours of a node
to the smallest of them, by an aggregate with map-side combine and a join that
adaptive execution splits at hot nodes. A few rounds suffice, as the depth of
the trees shrinks to its logarithm in each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.sinks.storage import Scratch


def _link_to_smallest(edges: DataFrame) -> DataFrame:
    """edges (a, b); adds m, the smallest of a and its neighbours b."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(smallest, "a").select("a", "b", F.least("a", "m").alias("m"))


def _summary(edges: DataFrame) -> tuple:
    return edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """links (a, b) of bigint nodes, in any direction. Returns node, label for
    every linked node but the labels themselves; a label is a component's
    smallest node. No links give no rows; loops and repeats don't matter."""
    turned = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = scratch.save(turned.filter("a != b").distinct())
    before = _summary(edges)
    while before[0]:
        both = edges.union(edges.select("b", "a"))
        large = _link_to_smallest(both).filter("b > a").select(F.col("b").alias("a"), "m")
        small = _link_to_smallest(large.select("a", F.col("m").alias("b")).distinct())
        moved = small.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
        stars = moved.union(small.select("a", F.col("m").alias("b"))).distinct()
        after = scratch.save(stars)
        scratch.drop(edges)
        edges, found = after, _summary(after)
        if found == before:
            break
        before = found
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
