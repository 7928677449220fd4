"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindling.llm.common import written


def connected_components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for every node of ``links`` (``a``, ``b``).

    Each round every node takes the smallest label among its neighbours, hands
    it to the node that its own label names, and jumps to its label's label,
    so labels travel twice as far each round. Minima are taken before the
    shuffle, so a node with very many links is no single task's. Every round is
    written; the driver only learns whether a label changed."""
    both = links.where(F.col("a") != F.col("b")).select("a", "b")
    both = written(spark, both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    labels = written(spark, labels.select("node", F.least("node", "low").alias("label")), "labels")
    while True:
        named = labels.select(F.col("node").alias("b"), "label")
        heard = both.join(named, "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("heard"))
        heard = labels.join(heard, "node").select("node", "label", F.least("label", "heard").alias("heard"))
        told = heard.select("node", F.col("heard").alias("new"), F.col("label").alias("old"))
        told = told.unionByName(heard.select(F.col("label").alias("node"), F.col("heard").alias("new"), F.lit(None).cast("long").alias("old")))
        told = told.groupBy("node").agg(F.min("new").alias("new"), F.max("old").alias("old"))
        jump = told.select(F.col("node").alias("at"), F.col("new").alias("jump"))
        new = told.join(jump, F.col("new") == F.col("at")).select("node", F.least("new", "jump").alias("label"), "old")
        new = written(spark, new, "labels")
        labels = new.drop("old")
        if new.where(F.col("label") != F.col("old")).isEmpty():
            return labels.withColumnRenamed("label", "component")
