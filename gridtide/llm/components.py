"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.session import cut


def _ranked(node: str) -> Column:
    """Nodes in an order that has nothing to do with the edges, so that chains shrink quickly."""
    return F.struct(F.xxhash64(node).alias("order"), F.col(node).alias("node"))


def components(edges: DataFrame) -> DataFrame:
    """`node` and `root` for every node of `edges` (`a`, `b`); a component has one root.

    In each round a node joins the first of itself and its neighbours, and edges inside what has
    joined vanish. Every round is written to the shared folder, so plans stay short.
    """
    rest = cut(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "edges")
    parents: list[DataFrame] = []
    while not rest.isEmpty():
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy("a").agg(F.min(_ranked("b")).alias("near"))
        parent = F.least(_ranked("a"), F.col("near"))["node"]
        parents.append(cut(first.select(F.col("a").alias("node"), parent.alias("parent")), "parents"))
        to = parents[-1]
        moved = (
            rest.join(to.select(F.col("node").alias("a"), F.col("parent").alias("pa")), "a")
            .join(to.select(F.col("node").alias("b"), F.col("parent").alias("pb")), "b")
            .where(F.col("pa") != F.col("pb"))
        )
        rest = cut(moved.select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct(), "edges")
    if not parents:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = parents[-1].select("node", F.col("parent").alias("root"))
    for step in reversed(parents[:-1]):
        later = roots.select(F.col("node").alias("parent"), "root")
        roots = step.join(later, "parent", "left").select("node", F.coalesce("root", "parent").alias("root"))
    return roots
