"""Connected components by minimum labels with pointer jumping, all on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqframe.llm.common import store


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` (smallest node of the component) for every node of ``edges`` (``u, v``).

    Each round takes the smallest label among a node and its neighbours, then replaces it by that
    label's own label, so a path shrinks geometrically.  Neighbours are reduced by ``min`` (map-side
    combine), so a hub linked with a third of all nodes is an ordinary node.
    """
    both = store(
        edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        .where("u <> v").distinct(), "edges")
    labels = store(both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("node"), F.least("u", "m").alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("v") == F.col("node")).groupBy("u").agg(
            F.min("label").alias("m"))
        hooked = labels.join(near, F.col("node") == F.col("u")).select(
            "node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        to = labels.select(F.col("node").alias("t"), F.col("label").alias("t_label"))
        jumped = hooked.join(to, F.col("label") == F.col("t"), "left").select(
            "node", "old", F.least("label", F.coalesce("t_label", "label")).alias("label"))
        jumped = store(jumped, "labels")
        changed = jumped.where("old <> label").limit(1).count()
        labels = jumped.select("node", "label")
        if not changed:
            return labels
