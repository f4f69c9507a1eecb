"""Connected components by label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapledger.llm.staging import staged


def connected_components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """``node, label`` for each node of ``edges`` (columns ``a`` and ``b``): the least node of its component.

    Each round every node takes the least label next to it and then that label's own
    label, so paths shorten by more than half a round. Labels and links stay in tables;
    each round is written as a table. A node with any number of links is one
    aggregated row; Spark combines its links before the shuffle. ``rows``: how many edges there
    are at most, if that is known.
    """
    both = edges.select("a", "b").filter("a <> b")
    both = staged(both.union(both.select("b", "a")).distinct(), rows and 2 * rows)
    nodes = both.count()
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label"))
    labels = staged(labels, nodes)
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("_to"))
        near = near.agg(F.min("label").alias("_near"))
        taken = labels.join(near, F.col("node") == F.col("_to")).select(
            "node", F.col("label").alias("_was"), F.least("label", "_near").alias("_least")
        )
        above = labels.select(F.col("node").alias("_above"), F.col("label").alias("_root"))
        moved = taken.join(above, F.col("_least") == F.col("_above")).select(
            "node", "_was", F.least("_least", "_root").alias("label")
        )
        moved = staged(moved, nodes)
        labels = moved.select("node", "label")
        if moved.filter("label <> _was").isEmpty():
            return labels
