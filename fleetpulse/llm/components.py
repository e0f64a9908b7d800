"""Connected components of links, by smallest labels and jumps, in joins: nothing is gathered.

Nodes are the non-null keys of common.row_key. Repeated links count once, a link of a node with itself not at all. No links
give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """For links between the structs a and b, each linked node with the smallest node of its component (node, label)."""
    both = stored(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(),
        "links",
    )
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("near")
        )
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        step = stored(lower, "labels")
        # The label of a label is at least as small.
        jump = step.select(F.col("node").alias("low"), F.col("low").alias("next"))
        jumped = stored(
            step.join(jump, "low", "left").select("node", "label", F.least("low", F.coalesce("next", "low")).alias("low")),
            "labels",
        )
        changed = jumped.where("low <> label").limit(1).count()
        labels = jumped.select("node", F.col("low").alias("label"))
        if not changed:
            return labels
