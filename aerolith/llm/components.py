"""Connected components of an edge table, by label passing and pointer jumping between stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.tables import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node that an edge names; the root is the component's smallest node.

    Every round takes the smallest root among the neighbours, then the root's root, so the distance to the
    smallest node at least halves on paths; each round is a written table, so a lost executor costs one
    round. Minima are combined before the shuffle, so a node with very many edges is no bottleneck.
    """
    one = edges.select(F.col(a).alias("node"), F.col(b).alias("near"))
    both = stored(one.unionByName(one.select(F.col("near").alias("node"), F.col("node").alias("near"))).distinct(), "edges")
    labels = stored(
        both.groupBy("node").agg(F.least(F.col("node"), F.min("near")).alias("root")).withColumn("moved", F.lit(True)), "labels"
    )
    while labels.where("moved").limit(1).count():
        known = labels.select("node", "root")
        near = (
            both.join(known.select(F.col("node").alias("near"), "root"), "near").groupBy("node").agg(F.min("root").alias("_near"))
        )
        jump = known.select(F.col("node").alias("root"), F.col("root").alias("_jump"))
        labels = stored(
            known.join(near, "node")
            .join(jump, "root", "left")
            .select("node", F.least("root", "_near", "_jump").alias("_root"), F.col("root").alias("_old"))
            .select("node", F.col("_root").alias("root"), (F.col("_root") < F.col("_old")).alias("moved")),
            "labels",
        )
    return labels.select("node", "root")
