"""Connected components of an edge table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, join_by_count, materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``edges(a, b)``: the least node of its component.

    Each round every node takes the least node next to it (or itself) as its
    parent; edges then run between parents, and those inside one parent vanish,
    so the edge table shrinks from round to round.  When none is left, the
    parents are followed back.  Rounds are written to the shared folder; the
    driver only learns whether edges are left and how many the busiest node
    has: edges of such hubs are not shuffled (:func:`join_by_count`).
    """
    left = materialize(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
                       "graph-edges")
    rounds, used = [], [left]
    while not rounds or not left.isEmpty():
        none, n = F.lit(0).cast("long"), F.count(F.lit(1))
        ends = left.groupBy("b").agg(F.min("a").alias("m"), none.alias("as_a"), n.alias("as_b")).withColumnRenamed("b", "node") \
            .union(left.groupBy("a").agg(F.min("a").alias("m"), n.alias("as_a"), none.alias("as_b")).withColumnRenamed("a", "node"))
        parents = materialize(ends.groupBy("node").agg(F.min("m").alias("parent"), F.sum("as_a").alias("as_a"),
                                                       F.sum("as_b").alias("as_b")), "graph-parents")
        rounds.append(parents)
        side = {e: parents.select(F.col("node").alias(e), F.col("parent").alias(f"p{e}"), f"as_{e}").where(f"as_{e} > 0") for e in "ab"}
        left = join_by_count(join_by_count(left, side["a"], "a", "as_a"), side["b"], "b", "as_b").where("pa <> pb")
        left = materialize(left.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "graph-edges")
        used.append(left)
    labels = rounds[-1].select("node", F.col("parent").alias("label"))
    for parents in reversed(rounds[:-1]):
        later = parents.groupBy("parent").agg(F.count(F.lit(1)).alias("n")) \
            .join(labels.select(F.col("node").alias("parent"), "label"), "parent", "left")
        later = materialize(later.select("parent", "n", F.coalesce("label", "parent").alias("label")), "graph-later")
        used += [later, labels]
        labels = materialize(join_by_count(parents, later, "parent", "n").select("node", "label"), "graph-labels")
    discard(*used, *(rounds if len(rounds) > 1 else []))
    return labels
