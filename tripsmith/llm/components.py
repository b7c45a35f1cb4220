"""Connected components of a link table, as joins and aggregations over edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripsmith.llm.common import materialise, release


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) of every node of ``links`` (a long, b long).

    Each round takes the least label among a node's neighbours, then follows labels once
    (pointer jumping), so long chains shorten quickly.  Labels are written to the shared
    folder after each round; only a count returns to the driver.

    Nodes that only link to themselves, and empty links, give no row: a node without another is its
    own component, which callers add.  Repeated links count once; null ends match nothing.
    """
    pairs = links.select(F.col("a").alias("_a"), F.col("b").alias("_b")).where("_a <> _b")
    edges = materialise(pairs.unionAll(pairs.select(F.col("_b"), F.col("_a"))).distinct(), "edges")
    labels = materialise(edges.groupBy(F.col("_a").alias("node"))
                         .agg(F.least(F.min("_b"), F.first("_a")).alias("component")), "labels")
    while True:
        near = (edges.join(labels.select(F.col("node").alias("_b"), F.col("component").alias("_l")), "_b")
                .groupBy(F.col("_a").alias("node")).agg(F.min("_l").alias("_l")))
        near = materialise(labels.join(near, "node").select(
            "node", F.least("component", "_l").alias("component"), F.col("component").alias("_old")), "near")
        release(labels)
        jump = near.select(F.col("node").alias("component"), F.col("component").alias("_far"))
        labels = materialise(near.join(jump, "component").select(
            "node", F.least("component", "_far").alias("component"),
            (F.least("component", "_far") < F.col("_old")).alias("_moved")), "labels")
        release(near)
        if not labels.where("_moved").limit(1).count():
            release(edges)
            return labels.select("node", "component")
