"""Connected components of links, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, stash


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of the nodes in ``links``
    (a, b: long; links with a null, or of a node with itself, are none).

    Every round a node takes the smallest label among its own and its
    neighbours', then the label of that label: distances shrink by powers of
    two.  Labels are joined to the links by the far node and their smallest is
    found by an aggregate that starts map-side, so the links of a node of any
    degree are dealt over tasks.  Each round is written to the shared folder,
    which cuts the lineage, and the round before is deleted; only the number of
    changed rows reaches the driver.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")
    edges = stash(both)
    step = stash(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("label"), F.lit(True).alias("changed")))
    while True:
        labels = step.select("node", "label")
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        new = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("further"))
        before, step = step, stash(new.join(jump, "new").select("node", F.least("new", "further").alias("label"), (F.least("new", "further") < F.col("label")).alias("changed")))
        release(before)
        if step.where("changed").isEmpty():
            release(edges)
            return step.select("node", F.col("label").alias("component"))
