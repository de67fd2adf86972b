"""Connected components of an edge table by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermend.llm.store import forget, written


def components(edges: DataFrame) -> DataFrame:
    """(node, component): each node of the edges (x, y) with the smallest node that it reaches.

    Every round takes the smallest label among neighbours, then the label of that label, so a
    path of length n needs about log n rounds. Each round's labels are a written table, which replaces the one before.
    """
    both = written(
        edges.select(F.col("x").alias("node"), F.col("y").alias("other"))
        .union(edges.select(F.col("y"), F.col("x")))
        .where("node <> other")
        .distinct(),
        "edges",
    )
    # The smallest neighbour serves as first label.
    labels = written(
        both.groupBy("node").agg(F.min("other").alias("low")).select("node", F.least("node", "low").alias("component")),
        "labels",
    )
    kept = labels
    while True:
        offers = both.join(labels.select(F.col("node").alias("other"), "component"), "other").select("node", "component")
        lowest = labels.union(offers).groupBy("node").agg(F.min("component").alias("component"))
        target = lowest.select(F.col("node").alias("component"), F.col("component").alias("next"))
        jumped = (
            lowest.join(target, "component", "left")
            .join(labels.select("node", F.col("component").alias("was")), "node")
            .select("node", F.least("component", F.coalesce("next", "component")).alias("component"), "was")
        )
        jumped = written(jumped, "labels")
        forget(kept)
        kept, labels = jumped, jumped.select("node", "component")
        if jumped.where("component <> was").isEmpty():
            forget(both)
            return labels
