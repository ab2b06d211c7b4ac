"""Connected components of a graph that only Spark holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightvault.llm.common import facts_of, stash


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) to ``(node, root)`` for each node that has an edge.

    Each round every node moves to the neighbour, or itself, whose salted hash
    is least; edges are renamed and the inner ones go.  The salt changes with
    the round, so that a chain halves in expectation however it is numbered,
    and no neighbour list is ever gathered: hubs cost one partial minimum, and meet
    their moves by broadcast as all hot keys do.
    """
    left = stash(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
    )
    labels, turn = None, 0
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("id"))  # noqa: E731, B023
        moves = both.groupBy("a").agg(F.min(rank("b")).alias("to"), F.count(F.lit(1)).alias("n"))
        moves = stash(moves.select(F.col("a").alias("u"), F.least("to", rank("a"))["id"].alias("to"), "n"), "moves")
        if labels is None:
            labels = moves.select(F.col("u").alias("node"), F.col("to").alias("root"))
        else:  # written each round, so that no plan grows with the rounds; a giant component has one root for many nodes
            held = labels.groupBy("root").agg(F.count(F.lit(1)).alias("n")).join(moves.select(F.col("u").alias("root"), "to"), "root", "left")
            held = stash(held.select("root", F.coalesce("to", "root").alias("to"), "n"), "held")
            labels = stash(facts_of(labels, held, "root").select("node", F.col("to").alias("root")), "labels")
        # A hub stands in many edges, on either side.
        at = moves.select(F.col("u").alias("a"), F.col("to").alias("ta"), "n")
        bt = moves.select(F.col("u").alias("b"), F.col("to").alias("tb"), "n")
        moved = facts_of(facts_of(left, at, "a"), bt, "b").where("ta <> tb")
        left = stash(moved.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "edges")
        turn += 1
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
