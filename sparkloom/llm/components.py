"""Connected components of a link table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def toward_least(links: DataFrame) -> DataFrame:
    """Fewer links (a, b) that connect the same nodes: of the smaller nodes that a node is linked to, the node and the
    others are linked to the least one.

    It pays where each node has few smaller neighbours, whose number bounds what is gathered for a node, and many nodes
    share them. Rows with a null end and links of a node to itself are left out; repeated links count once."""
    below = links.where("a <> b").groupBy(F.greatest("a", "b").alias("node")).agg(F.collect_set(F.least("a", "b")).alias("near"))
    ends = F.array_union("near", F.array("node"))
    return below.select(F.explode(ends).alias("a"), F.array_min("near").alias("b")).where("a <> b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` has columns ``a`` and ``b`` of one ordered type. Returns ``node`` and ``label``, the smallest node
    that can be reached from it, for each node that has a link to another one.

    Each round takes the smallest label among a node's neighbours and then jumps from label to label, so the
    number of rounds grows with the logarithm of the longest path. Rounds end in files in the shared folder.
    Rows with a null end and links of a node to itself are ignored; repeated links count once."""
    links = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    both = materialize(links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("label")), "labels")
    while True:
        around = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        closer = labels.join(around, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        far = labels.select(F.col("node").alias("label"), F.col("label").alias("onward"))
        moved = materialize(closer.join(far, "label").select("node", "was", F.least("label", "onward").alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.where("was <> label").isEmpty():
            return labels
