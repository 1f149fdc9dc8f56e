"""Connected components of a graph of links, by smallest label, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewell.sources.stages import Stages


def components(links: DataFrame, stages: Stages) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node it can reach.

    Each round takes the smallest label among the neighbours and then the label of that label, so
    that chains shrink by half. Labels are stage tables; only the number of changes is returned to
    the driver. Loops and repeated links do no harm.
    """
    both = stages.write(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .distinct(),
        "links",
    )
    labels = stages.write(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        .select("node", F.least("node", "b").alias("component")),
        "labels",
    )
    while True:
        near = (
            both.join(labels, both["b"] == labels["node"]).groupBy("a")
            .agg(F.min("component").alias("near"))
        )
        hooked = stages.write(
            labels.join(near, labels["node"] == near["a"])
            .select("node", F.col("component").alias("old"),
                    F.least("component", "near").alias("component")),
            "hooked",
        )
        up = hooked.select(F.col("node").alias("parent"), F.col("component").alias("above"))
        following = stages.write(
            hooked.join(up, hooked["component"] == up["parent"])
            .select("node", "old", F.least("component", "above").alias("component")),
            "labels",
        )
        labels = following.select("node", "component")
        if following.where("old <> component").isEmpty():
            return labels
