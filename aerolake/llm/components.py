"""Connected components by rounds of smallest neighbour labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.session import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b); the label is the component's smallest node.

    A round takes the smallest label among a node's neighbours, then the label of that
    label.  Labels only fall, and rounds end when none does.  Nothing is collected; a
    node with many edges is aggregated map-side.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "cc-edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "cc-labels")
    while True:
        told = both.join(labels.withColumnsRenamed({"node": "b", "label": "other"}), "b").groupBy(F.col("a").alias("node")).agg(F.min("other").alias("other"))
        lower = labels.join(told, "node").select("node", F.col("label").alias("old"), F.least("label", "other").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = stored(lower.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("next", "label")).alias("label")), "cc-labels")
        labels = moved.select("node", "label")
        if not moved.where("label <> old").limit(1).count():
            return labels
