"""Connected components of a graph given by its edges, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.llm.shared import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the component's least node.

    Edges are contracted until none is left. In every round each node moves to the first of itself
    and its neighbours in an order that is drawn anew for the round, then once more to where that node
    went; edges follow their ends, and those that became loops or copies go. Whatever the graph, a node
    with an edge stays where it is with a chance of at most a half, and so the nodes left fall by a
    constant factor a round on average: chains of any length and order take a logarithm of rounds, and
    the tables of all rounds together are a constant times the edges. Nodes may be numbers, texts or
    binary; NULL ends are left out. Rounds are written to the shared folder. A node's edges are reduced
    map-side before they meet.
    """
    spark = edges.sparkSession
    known = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL")
    nodes = known.select(F.col("a").alias("node")).unionByName(known.select(F.col("b").alias("node")))
    left = stored(_once(known), spark, "component-edges")
    moves: list[DataFrame] = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        drawn = F.struct(F.xxhash64("b", F.lit(len(moves))).alias("drawn"), F.col("b").alias("to"))
        own = F.struct(F.xxhash64("a", F.lit(len(moves))).alias("drawn"), F.col("a").alias("to"))
        near = both.groupBy("a").agg(F.min(drawn).alias("near"))
        first = stored(
            near.select(F.col("a").alias("node"), F.least("near", own)["to"].alias("to")),
            spark,
            "component-first",
        )
        again = first.select(F.col("node").alias("to"), F.col("to").alias("onward"))
        move = stored(
            first.join(again, "to").select("node", F.col("onward").alias("to")), spark, "component-moves"
        )
        moves.append(move)
        ends = left.join(move.select(F.col("node").alias("a"), F.col("to").alias("a_to")), "a")
        ends = ends.join(move.select(F.col("node").alias("b"), F.col("to").alias("b_to")), "b")
        left = stored(_once(ends.select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))), spark, "component-edges")
    if not moves:
        return nodes.distinct().select("node", F.col("node").alias("root"))
    # Backwards: where a node went in one round, it went on from in the next.
    place = moves[-1]
    for move in reversed(moves[:-1]):
        onward = place.select(F.col("node").alias("to"), F.col("to").alias("end"))
        place = stored(
            move.join(onward, "to", "left").select("node", F.coalesce("end", "to").alias("to")),
            spark,
            "component-places",
        )
    least = place.groupBy("to").agg(F.min("node").alias("root"))
    linked = place.join(least, "to").select("node", "root")
    return nodes.distinct().join(linked, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def _once(edges: DataFrame) -> DataFrame:
    """Every edge once, whichever way round it was, without loops."""
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a != b").distinct()
