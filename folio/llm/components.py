"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung below the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.selectExpr("b as a", "a as b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").selectExpr("b as a", "m as b").filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hung below the smallest of them; edges come as a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(least, "a").selectExpr("b as a", "m as b").filter("a <> b").unionByName(least.selectExpr("a", "m as b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): component is the smallest node that links reach.

    Each round is joins and minima with map-side partial results, so a node with
    very many neighbours is never gathered; rounds grow with the logarithm of
    the number of nodes.  Links of a node with itself add nothing; no links, no rows.
    """
    edges = checkpointed(links.selectExpr("greatest(a, b) as a", "least(a, b) as b").filter("a <> b").distinct())
    state = _state(edges)
    while state[0]:
        edges = checkpointed(_small_star(_large_star(edges)))
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.selectExpr("a as node", "b as component").unionByName(edges.selectExpr("b as node", "b as component").distinct())
