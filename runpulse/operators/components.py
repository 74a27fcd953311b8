"""Connected components of a graph in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from runpulse.session import cut_lineage, discard


def _state(edges: DataFrame) -> tuple:
    """A fingerprint of the set of edges, independent of their order."""
    h = edges.select(F.xxhash64("u", "v").alias("h"))
    return tuple(h.agg(F.count("*"), F.expr("bit_xor(h)"), F.sum(F.col("h").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """Rows (`node`, `component`): every node with an edge, and the smallest node it can reach.

    Alternating large-star and small-star steps: each node hangs its larger neighbours on its smallest one, then
    its smaller neighbours. A step is a grouped minimum (added up before the shuffle) and a join with it, so a
    node with very many neighbours is only ever the many-rows side of a join with one row, which Spark splits.
    Each round is written to the shared folder and read back, and the round before is deleted; the number of rounds
    grows with the logarithm of the longest chain. Loops and repeated edges are ignored; nodes that are null have no edges.
    """
    e = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    e = cut_lineage(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        now = _state(e)
        if now == before or now[0] == 0:
            return (
                e.select(F.col("u").alias("node"), F.col("v").alias("component"))
                .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")))
                .groupBy("node")
                .agg(F.min("component").alias("component"))
            )
        before, last = now, e
        sides = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sides.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut_lineage(large.distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut_lineage(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "small")
        discard(last, large)
