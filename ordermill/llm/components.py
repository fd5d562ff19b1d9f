"""Connected components of a link table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import stage


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every node of `links` but the roots; root is the smallest reachable node.

    Each round gives every node's larger neighbours, then its smaller ones, to the smallest
    neighbour it knows (large-star and small-star steps), until the links are stars.  A round is
    written out, so lineage stays short; the driver reads only two sums per round.  A node with very
    many neighbours is folded by partial aggregates; the sums are written too, so that the joins
    back are between plain tables, whose hot keys adaptive execution splits.
    """
    pair = F.struct(F.greatest(left, right).alias("a"), F.least(left, right).alias("b"))
    edges = stage(links.where(F.col(left) != F.col(right)).select(pair.alias("e")).select("e.a", "e.b").distinct(), "edges")
    last = None
    while True:
        both = edges.union(edges.select("b", "a"))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        lowest = stage(lowest, "lowest")
        larger = edges.select(F.col("b").alias("a"), F.col("a").alias("other"))  # other > a
        large = larger.join(lowest, "a").select(F.col("other").alias("a"), F.col("low").alias("b"))
        large = stage(large.distinct(), "large-star")
        least = stage(large.groupBy("a").agg(F.min("b").alias("low")), "least")
        small = large.join(least, "a")
        edges = small.select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
        edges = stage(edges.select("e.a", "e.b").where("a != b").distinct(), "edges")
        # unsigned sums would do as well: any change of the link set changes them
        now = edges.select(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == last:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        last = now
