"""Groups of linked nodes: contraction of an edge table, round by round.

Every round nodes are put in a new random order (a hash of the node and the
round), each node points to its least neighbour (or itself) by that order,
pointers are followed once more, and edges are rewritten to the pointed-to
nodes. Without the new order, a chain of ascending nodes would shrink by two
nodes a round; with it, any graph shrinks by a constant share. All joins are of
stored tables on plain shuffles, so a hub's rows can be split; minimums are
pre-aggregated in every task. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.packed import drop, stored


def linked_groups(edges: DataFrame) -> DataFrame:
    """(``node``, ``group``) of every node of ``edges`` (a, b): ``group`` is one node of its component.

    An empty edge table gives an empty result; self-loops and repeated edges
    change nothing. Rounds go on until no edge joins two groups.
    """
    edges = stored(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
                   "edges")
    groups, turn = None, 0
    while not edges.isEmpty():
        turn += 1
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
        ranked = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("order"), F.col(c).alias("node"))  # noqa: E731, B023
        near = stored(both.groupBy("node").agg(F.min(ranked("other")).alias("least")).select(
            "node", F.least("least", ranked("node"))["node"].alias("to")), "pointers")
        onward = near.select(F.col("node").alias("to"), F.col("to").alias("next"))
        to = stored(near.join(onward, "to").select("node", F.col("next").alias("to")), "pointers")
        drop(near)
        before = groups
        if before is None:
            groups = stored(to.withColumnRenamed("to", "group"), "groups")
        else:
            moved = to.select(F.col("node").alias("group"), "to")
            groups = stored(before.join(moved, "group", "left").select(
                "node", F.coalesce("to", "group").alias("group")), "groups")
            drop(before)
        left, right = to.select(F.col("node").alias("a"), F.col("to").alias("x")), \
            to.select(F.col("node").alias("b"), F.col("to").alias("y"))
        following = stored(edges.join(left, "a").join(right, "b").filter("x <> y").select(
            F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        drop(edges, to)
        edges = following
    if groups is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("group"))
    drop(edges)
    return groups
