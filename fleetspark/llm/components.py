"""Connected components of an edge table by label exchange and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetspark.llm.common import shared_table


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (a, b longs); label is the smallest node of its component.

    Each round a node takes the smallest label among itself and its neighbours,
    then the label of its label, so the rounds grow with the logarithm of a
    component's diameter. Labels are written to the shared folder every round."""
    spark = edges.sparkSession
    both = shared_table(spark, edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select("b", "a")).distinct(), "edges")
    labels = shared_table(spark, both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("seen")))
        best = (labels.join(near, labels.node == near.a, "left")
                      .select("node", F.col("label").alias("old"), F.least("label", "seen").alias("mid")))
        up = labels.select(F.col("node").alias("via"), F.col("label").alias("top"))
        moved = shared_table(spark, best.join(up, best.mid == up.via, "left")
                             .select("node", "old", F.least("mid", "top").alias("label")), "labels")
        if moved.where("label <> old").isEmpty():
            return moved.select("node", "label")
        labels = moved.select("node", "label")
