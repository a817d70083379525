"""Connected components of a link table, by smallest labels and shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.session import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over links (a, b), for all linked nodes.

    Every round takes the smallest label among the neighbours and then the label of the label, so
    that paths halve; rounds are written to the shared folder. Only counts reach the driver.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other")))
    edges = materialise(both.distinct(), "links")
    labels = materialise(
        edges.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("component")), "labels"
    )
    while True:
        of = labels.select(F.col("node").alias("other"), F.col("component").alias("near"))
        near = edges.join(of, "other").groupBy("node").agg(F.min("near").alias("near"))
        lowered = labels.join(near, "node").select(
            "node", F.col("component").alias("was"), F.least("component", "near").alias("component")
        )
        step = of.select(F.col("other").alias("component"), F.col("near").alias("up"))
        jumped = lowered.join(step, "component", "left").select(
            "node", "was", F.least("component", F.coalesce("up", "component")).alias("component")
        )
        written = materialise(jumped, "labels")
        labels = written.select("node", "component")
        if not written.filter(F.col("was") != F.col("component")).take(1):
            return labels
