"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.scratch import kept


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); ``component`` is the smallest node reachable.

    In each round every node joins the neighbour (or itself) that comes first in a
    random order, joined nodes become one, and links inside it vanish.  About a
    constant share of the nodes goes each round, also on long chains; all work is
    joins and grouped minima, so a node with very many links is no single task.
    """
    edges = kept(links.select("a", "b").where("a <> b").distinct(), "links")
    none = edges.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    labels, turn = none, 0
    while not edges.isEmpty():
        turn += 1

        def rank(node, turn=turn):
            return F.struct(F.xxhash64(F.lit(turn), node).alias("order"), node.alias("node"))

        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy("a").agg(F.min(rank(F.col("b"))).alias("best"))
        parents = kept(first.select(F.col("a").alias("child"), F.least(F.col("best"), rank(F.col("a")))["node"].alias("parent")), "parents")
        a, b = parents.toDF("a", "pa"), parents.toDF("b", "pb")
        edges = kept(edges.join(a, "a").join(b, "b").where("pa <> pb").select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct(), "links")
        if turn == 1:
            labels = parents.toDF("node", "root")
        else:
            labels = labels.join(parents, F.col("root") == F.col("child"), "left").select("node", F.coalesce("parent", "root").alias("root"))
    smallest = labels.groupBy("root").agg(F.min("node").alias("component"))
    return labels.join(smallest, "root").select("node", "component")
