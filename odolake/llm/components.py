"""Connected components of a link table by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from odolake.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b); the label is the smallest node of its component.

    Every round takes the smallest label of the neighbours and then the label of the label, so the number of
    rounds grows with the logarithm of the longest path. Each round is written to the shared folder. The links are read
    in every round. Labels are done when both ends of every link have the same one.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
    labels = stored(labels.select("node", F.least("node", "near").alias("label")), "labels")
    while True:
        ends = [labels.select(F.col("node").alias(c), F.col("label").alias(f"of_{c}")) for c in ("a", "b")]
        if links.join(ends[0], "a").join(ends[1], "b").where("of_a <> of_b").isEmpty():
            return labels
        named = labels.select(F.col("node").alias("b"), F.col("label").alias("near"))
        near = both.join(named, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        lower = labels.join(near, "node").select("node", F.least("label", "near").alias("low"))
        root = labels.select(F.col("node").alias("low"), F.col("label").alias("root"))
        labels = stored(lower.join(root, "low").select("node", F.least("low", "root").alias("label")), "labels")
