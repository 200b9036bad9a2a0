"""Connected components by star contraction, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import stored

ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for the nodes of ``links`` (``a, b``): root is the smallest node of the component.

    Each round lets every node pass its smallest neighbour to its larger ones and
    then to its smaller ones. All steps are a minimum per node with a partial
    minimum per task, and a join on the node that Spark can split when one node
    has very many links. Rounds grow with the logarithm of the longest chain.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    edges = stored(links.select(a.alias("a"), b.alias("b")).filter("a > b").distinct(), "edges")
    before = _mark(edges)
    for _ in range(ROUNDS):
        edges = stored(_to_smaller(_to_larger(edges)), "edges")
        now = _mark(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _mark(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())


def _to_larger(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct()


def _to_smaller(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    passed = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return passed.unionByName(least.select("a", F.col("m").alias("b"))).filter("a > b").distinct()
