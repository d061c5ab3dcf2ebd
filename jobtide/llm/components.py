"""Connected components of links between documents, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.text import saved

#: Up to so many links are worked on in one task, without a shuffle; more are dealt out.
FEW = 250_000


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step: links (a > b) of each node to larger (or to smaller) neighbours go to its smallest neighbour instead."""
    if large:
        sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    moved = sides.join(least, F.col("u") == F.col("w"))
    if large:
        out = moved.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("w").alias("a"), F.col("m").alias("b")))
    return out.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links`` (a, b); a label is the smallest node of the component.

    Large stars and small stars in turn (Kiveris et al.) end after about log n rounds.
    Every round is written to the shared folder, and rounds over ``FEW`` links or fewer are
    one task each. Links from a node to itself and null ends are ignored.
    """
    ordered = links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = saved(ordered, "links")
    mark = None
    while True:
        seen = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
        dealt = edges.coalesce(1) if seen[0] <= FEW else edges
        edges = saved(_stars(_stars(dealt, True), False), "links")
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return found.union(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
