"""Connected components by contraction: nothing but narrow joins and minima.

Every node takes the smallest label among itself and its neighbours, and then that
label's own; edges are rewritten to labels, loops and repeats fall away, and the
rest goes on. The number of labels that still have edges shrinks with every round,
so the rounds grow with the logarithm of a component's size. Each round's edges
and labels are written to the shared folder: no lineage piles up, and the driver
sees only whether any edge is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakeferry.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b); label is one of the component's nodes."""
    left = stored(_plain(edges), "edges")
    labels = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    labels = stored(labels.withColumn("label", F.col("node")), "labels")
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("to"))
        least = stored(least, "least")
        jump = least.select(F.col("a").alias("to"), F.col("to").alias("further"))
        least = stored(
            least.join(jump, "to", "left").select("a", F.coalesce("further", "to").alias("to")), "least"
        )
        start = least.select("a", F.col("to").alias("from_a"))
        end = least.select(F.col("a").alias("b"), F.col("to").alias("from_b"))
        moved = left.join(start, "a").join(end, "b").select(F.col("from_a").alias("a"), F.col("from_b").alias("b"))
        left = stored(_plain(moved), "edges")
        step = least.select(F.col("a").alias("label"), "to")
        labels = stored(
            labels.join(step, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels"
        )
    return labels


def _plain(edges: DataFrame) -> DataFrame:
    """Each edge once, smaller node first, no loops."""
    return (
        edges.where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
