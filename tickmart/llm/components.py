"""Connected components of a link table, by labels that travel along links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmart.sinks.tables import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: the smallest node that each linked node can reach.

    ``links`` holds pairs of non-null longs.  Every round gives each node the
    smallest label around it and then the label of that label (path halving),
    so a chain shortens by a factor a round; labels are staged each round, which
    cuts lineage.  Nothing but one count a round reaches the driver.
    """
    both = stage(links.select(F.col(a).alias("x"), F.col(b).alias("y"))
                 .unionByName(links.select(F.col(b).alias("x"), F.col(a).alias("y"))).distinct(), "links")
    labels = stage(both.groupBy("x").agg(F.min("y").alias("m"))
                   .select(F.col("x").alias("node"), F.least("x", "m").alias("label")), "labels")
    while True:
        around = (both.join(labels, both["y"] == labels["node"])
                  .groupBy("x").agg(F.min("label").alias("near")))
        near = (labels.join(around, labels["node"] == around["x"])
                .select("node", "label", F.least("label", "near").alias("near")))
        # The label of the new label: one more hop.
        hop = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        moved = stage(near.join(hop, "near", "left")
                      .select("node", "label", F.least("near", F.coalesce("far", "near")).alias("new")), "labels")
        changed = moved.where("new <> label").limit(1).count()
        labels = moved.select("node", F.col("new").alias("label"))
        if not changed:
            return labels.select("node", F.col("label").alias("component"))
