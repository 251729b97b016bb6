"""Connected components of an edge table, without bringing edges or labels to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.llm import store


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of ``edges``; label is the least node of its component.

    Each round takes the least label of the neighbours and then the label's own label, so the
    rounds follow the logarithm of the longest path, not its length.  A node with very many
    edges only ever has many rows in a join that the engine can split, and a minimum that is
    combined before the shuffle.  Every round is written, so a lost executor costs one round.
    Null ends are ignored; loops and repeated edges change nothing; no edges give no rows.
    """
    pair = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    both = pair.unionByName(pair.select(F.col("y").alias("x"), F.col("x").alias("y")))
    both = store.materialize(both.distinct(), "links")
    labels = store.materialize(both.groupBy(F.col("x").alias("node")).agg(F.least("node", F.min("y")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("y"), "label"), "y").groupBy(F.col("x").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("label").alias("far"))
        step = step.join(jump, "mid").select("node", "old", F.least("mid", "far").alias("label"))
        step = store.materialize(step, "labels")
        labels = step.select("node", "label")
        if step.where("old <> label").isEmpty():
            return labels
