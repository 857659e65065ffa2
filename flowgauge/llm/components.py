"""Connected components of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowgauge.llm.tables import kept


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and component (the smallest node of its component) of every node in ``links``.

    Each round gives a node the smallest label around it and then the label of that label; every round is kept as
    a table, and the driver only counts changes. Links of a hot node are split by Spark's skew handling.
    """
    one = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    both = kept(one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = kept(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select(
        "node", F.least("node", "b").alias("component")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("near"))
        lower = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.least("component", "near").alias("component"), F.col("component").alias("old"))
        over = labels.select(F.col("node").alias("up"), F.col("component").alias("above"))
        new = kept(lower.join(over, F.col("component") == F.col("up")).select(
            "node", F.least("component", "above").alias("component"), "old"), "labels")
        labels = new.select("node", "component")
        if new.where("component <> old").isEmpty():
            return labels
