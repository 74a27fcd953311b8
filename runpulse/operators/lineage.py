"""Pipelines downstream and upstream of failing ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from runpulse.session import cut_lineage, discard

#: Rounds after which what was found is written as one table again.
COMPACT = 4


def _reached(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Rows (`root`, `node`, `depth`): every node reachable along `links` (`start`, `end`), with its distance in steps.

    Rounds go on until one finds nothing new, so chains of any length are followed and cycles end. Each
    round's find is written to the shared folder and read back, which keeps the plan short and lets a lost
    executor's work be read again instead of recomputed from the first round. Every few rounds the finds become one table, so
    a round reads a bounded number of tables however long the chains are. Names repeat in these tables, so their files are far
    smaller than their rows and Spark would send each round's through the driver as a broadcast; both joins are merges instead.
    """
    first = roots.select(F.col("pipeline_id").alias("root"), F.col("pipeline_id").alias("node")).distinct()
    base = frontier = cut_lineage(first.withColumn("depth", F.lit(0)), "impact")
    links = cut_lineage(links.distinct(), "edges")
    recent: list[DataFrame] = []
    depth = 0
    while True:
        depth += 1
        found = reduce(DataFrame.unionByName, recent, base)
        reached = (
            frontier.join(links.hint("merge"), F.col("node") == F.col("start"))
            .select("root", F.col("end").alias("node"))
            .distinct()
            .join(found.select("root", "node").hint("merge"), ["root", "node"], "left_anti")
        )
        frontier = cut_lineage(reached.withColumn("depth", F.lit(depth)), "impact")
        if frontier.isEmpty():
            return found.filter(F.col("depth") > 0)
        recent.append(frontier)
        if len(recent) == COMPACT:
            # the last find stays: the next round starts from it
            merged = cut_lineage(reduce(DataFrame.unionByName, recent[:-1], base), "impact")
            discard(base, *recent[:-1])
            base, recent = merged, recent[-1:]


def downstream_impact(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """Every pipeline reachable from a root along `edges`, with its distance in steps."""
    links = edges.select(F.col("upstream").alias("start"), F.col("downstream").alias("end"))
    return _reached(roots, links).select("root", F.col("node").alias("downstream"), F.col("depth").cast("bigint").alias("depth"))


def upstream_impact(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """Every pipeline from which a root is reached along `edges`, with its distance in steps."""
    links = edges.select(F.col("downstream").alias("start"), F.col("upstream").alias("end"))
    return _reached(roots, links).select("root", F.col("node").alias("upstream"), F.col("depth").cast("bigint").alias("depth"))
