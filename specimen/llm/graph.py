"""Connected components of an edge table, as a loop of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specimen.llm.common import drop_written, written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b: long); the label is the
    least node of its component.

    Each round takes the least label among a node and its neighbours and then
    jumps to that label's own label, so a path of length n needs about log n
    rounds of two joins.  The least label per node is aggregated before the
    exchange, and every round is written to the shared folder, so a lost
    executor repeats one round at most.
    """
    own = edges.select("a", F.col("a").alias("b")).union(edges.select(F.col("b").alias("a"), "b"))
    both = written(edges.select("a", "b").union(edges.select("b", "a")).union(own).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")), "labels")
    while True:
        step = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(
                    F.min("label").alias("_low"), F.max(F.when(F.col("a") == F.col("b"), F.col("label"))).alias("_old")))
        up = labels.select(F.col("node").alias("_low"), F.col("label").alias("_up"))
        moved = written(step.join(up, "_low").select(
            "node", F.least("_low", "_up").alias("label"), "_old"), "labels")
        drop_written(labels)
        labels = moved
        if moved.filter(F.col("label") != F.col("_old")).isEmpty():
            drop_written(both)
            out = moved.select("node", "label")
            out._scratch_path = moved._scratch_path
            return out
