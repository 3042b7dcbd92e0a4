"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.staging import staged
from fleetmart.operators.lookup import fits_broadcast, lookup_join


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of an edge (a, b) the smallest node of its component.

    Each round every node takes the smallest label among its own and its neighbours', then the label of its label, so a
    path shortens to less than half. Labels are minima, combined before the shuffle; a label that very many nodes have, and a
    node with very many neighbours, are split off by the lookups. Loops are allowed and keep a single node; edges with a null
    end are left out.
    """
    both = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull()).select("a", "b")
    both = staged(both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                    .select("node", F.least("node", "low").alias("root")))
    bounded = fits_broadcast(labels)  # they stay as many
    while True:
        seen = (lookup_join(both, labels.select(F.col("node").alias("b"), F.col("root").alias("near")), ["b"], bounded=bounded)
                .groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near")))
        closer = labels.join(seen, "node").select("node", "root", F.least("root", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("root").alias("next"))
        moved = staged(lookup_join(closer, jump, ["new"], bounded=bounded).select("node", F.col("root").alias("old"), F.col("next").alias("root")))
        labels = moved.select("node", "root")
        if not moved.where("root < old").limit(1).count():
            return labels
