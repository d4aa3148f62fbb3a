"""Connected components by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every end of an edge (columns ``a`` and ``b``): the smallest node reachable.

    Each round points every node to its smallest neighbour, follows the pointers to their ends, and
    replaces the nodes of the edges by those ends, which leaves few edges for the next round. What
    a round gives is written, which cuts the lineage; only whether anything is left to do comes to
    the driver. Null ends are left out, loops are harmless.
    """
    whole = edges.where("a IS NOT NULL AND b IS NOT NULL")
    left = whole.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left = written(left, "edges")
    labels = None
    while labels is None or not left.isEmpty():
        ends = left.select(F.col("a").alias("node"), F.col("b").alias("near"))
        ends = ends.union(left.select(F.col("b").alias("node"), F.col("a").alias("near")))
        found = _followed(written(ends.groupBy("node").agg(F.min(F.least("node", "near")).alias("label")), "pointers"))
        if labels is None:
            labels = found
        else:
            onward = found.select(F.col("node").alias("label"), F.col("label").alias("_next"))
            moved = labels.join(onward, "label", "left")
            labels = written(moved.select("node", F.coalesce("_next", "label").alias("label")), "labels")
        first = found.select(F.col("node").alias("a"), F.col("label").alias("_a"))
        second = found.select(F.col("node").alias("b"), F.col("label").alias("_b"))
        moved = left.where("a <> b").join(first, "a").join(second, "b").where("_a <> _b")
        left = written(moved.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "edges")
    return labels


def _followed(pointers: DataFrame) -> DataFrame:
    """Pointers to smaller nodes, each followed to its end in a logarithmic number of steps."""
    while True:
        onward = pointers.select(F.col("node").alias("label"), F.col("label").alias("_next"))
        moved = written(pointers.join(onward, "label"), "pointers")
        pointers = moved.select("node", F.col("_next").alias("label"))
        if moved.where("_next <> label").isEmpty():
            return pointers
