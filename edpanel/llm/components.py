"""Connected components of an edge table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edpanel.llm.common import drop_written, written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b): the smallest node it is connected to.
    Every round takes the least label among the neighbours and then the label's own label, and
    is written to the shared folder; it ends when no label changes."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a != b").distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near")))
        better = (labels.join(near, labels.node == near.a)
                  .select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        up = labels.select(F.col("node").alias("via"), F.col("label").alias("above"))
        new = written(better.join(up, better.label == up.via, "left")
                      .select("node", "old", F.least("label", F.coalesce("above", "label")).alias("label")), "labels")
        drop_written(labels)
        labels = new.select("node", "label")
        if new.where("label != old").isEmpty():
            drop_written(both)
            return labels
