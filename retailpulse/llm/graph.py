"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailpulse.llm.common import stored


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b: long); root is the smallest node reachable.

    Each round hangs the neighbours of a node on its smallest neighbour (the larger
    ones first, then the smaller ones with the node itself), so paths shrink to stars
    in about log(n) rounds. A node's neighbours are never gathered: only their minimum
    is, combined before the shuffle. Self links and repeated links change nothing; an
    empty table gives an empty one. Every round is stored in the shared folder.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _checksum(edges)
    while seen[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", "m"))
        edges = stored(small.where("a <> b").distinct())
        now = _checksum(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
