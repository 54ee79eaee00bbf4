"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stationflow.llm.staging import staged
from stationflow.operators.skew import one_per_key


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node it reaches.

    Large stars and small stars in turns: each node's larger, then its smaller
    neighbours are linked to its smallest one, until nothing changes. Every round
    is two joins on a node against the node's minimum, which is aggregated before
    it is shuffled; a node with many links is split by adaptive execution. Rounds
    grow as the logarithm of the longest chain.
    """
    edges = staged(_directed(links), "links")
    before = None
    for _ in range(most_rounds):
        edges = staged(_small_star(_large_star(edges)), "links")
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots).groupBy("node").agg(F.min("component").alias("component"))


def _directed(links: DataFrame) -> DataFrame:
    """Each link once, from the larger node to the smaller."""
    return links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = one_per_key(both, ["a"], F.min("b").alias("m"))
    larger = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))  # b > a
    joined = larger.join(least, "a").select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
    return joined.filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    least = one_per_key(edges, ["a"], F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
