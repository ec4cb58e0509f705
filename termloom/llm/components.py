"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from termloom.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is linked to the node's smallest neighbour (or itself)."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).filter(F.col("a") != F.col("b"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the smallest node it is connected to.

    Each round of two contractions roughly squares how far labels have come; rounds end when one changes
    nothing, as all edges form stars. Rounds read and write tables, so a lost executor costs one round. No
    links give no rows.
    """
    pairs = links.filter(F.col("a") != F.col("b"))
    edges = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = materialize(edges, "edges"), None
    while True:
        now = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("mark")).first()
        if now == before or not now["n"]:
            break
        before = now
        edges = materialize(_small_star(_large_star(edges).distinct()).distinct(), "edges")
    own = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(own)
