"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitstop.llm.scratch import stage


def connected(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the smallest
    node that can be reached.  Every round is two grouped minima and joins
    back to the links, staged in the shared folder; a node with very many
    links is pre-aggregated before it is shuffled."""
    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.union(edges.select("b", "a")) if large else edges   # a > b in edges
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        joined = both.join(least, "a")
        if large:
            return joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        to_least = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return to_least.union(least.select("a", F.col("m").alias("b"))).distinct()

    def signature(edges: DataFrame):
        return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()

    edges = stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .filter("a <> b").distinct(), "cc-edges")
    seen = signature(edges)
    while seen[0]:
        edges = stage(star(star(edges, True), False), "cc-edges")
        now = signature(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)
