"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.llm.tables import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: bigint); root is the least node reachable.

    Each round points every node to its least neighbour, if that is less than
    itself, follows the pointers once more, and keeps only the edges between
    different targets, with the targets as their ends.  Nodes only ever merge
    along edges, and the least node of a component never moves, so when no edge
    is left the pointers, followed in turn, lead to it.  The number of rounds
    grows with the logarithm of the longest path.  Minima are combined before
    the shuffle, so a node with very many edges does not fill one task.  No edges
    give no rows.
    """
    both = edges.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    live = stored(both.distinct(), "edges")
    mapping = None
    while not live.isEmpty():
        ends = live.select("a", "b").union(live.select(F.col("b"), F.col("a")))
        least = ends.toDF("node", "other").groupBy("node").agg(F.min("other").alias("other"))
        first = stored(
            least.select("node", F.least("node", "other").alias("to")), "pointers"
        )
        second = first.select(F.col("node").alias("to"), F.col("to").alias("far"))
        step = stored(first.join(second, "to").select("node", F.col("far").alias("to")), "jumps")
        at_a = step.select(F.col("node").alias("a"), F.col("to").alias("new_a"))
        at_b = step.select(F.col("node").alias("b"), F.col("to").alias("new_b"))
        live = stored(
            live.join(at_a, "a")
            .join(at_b, "b")
            .where("new_a <> new_b")
            .select(
                F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")
            )
            .distinct(),
            "edges",
        )
        if mapping is None:
            mapping = step.select("node", F.col("to").alias("root"))
        else:
            # A target that has lost all its edges is final.
            moved = step.select(F.col("node").alias("root"), "to")
            mapping = stored(
                mapping.join(moved, "root", "left").select(
                    "node", F.coalesce("to", "root").alias("root")
                ),
                "mapping",
            )
    return mapping if mapping is not None else live.select(
        F.col("a").alias("node"), F.col("b").alias("root")
    )
