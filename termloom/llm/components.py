"""Connected components of links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.session import staged


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """``(node, component)`` of all ends of ``links (a, b)``: the smallest id that can be reached.

    In each round a node takes the smallest label among its neighbours and itself, and then
    the label of its label, so that long chains halve. Each round is written to the shared
    folder. Only the number of changed rows comes to the driver. ``rows``: about how many
    nodes there are, where that is known (see ``staged``).
    """
    both = links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct()
    both = staged(both, "links", rows)
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component"))
    labels = staged(labels, "labels", rows)
    while True:
        heard = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("heard"))
        near = labels.join(heard, F.col("node") == F.col("a"), "left").select(
            "node", "component", F.least("component", "heard").alias("near")
        )
        of = labels.select(F.col("node").alias("via"), F.col("component").alias("far"))
        new = near.join(of, F.col("near") == F.col("via"), "left").select(
            "node", F.least("near", "far").alias("component"), (F.least("near", "far") < F.col("component")).alias("moved")
        )
        new = staged(new, "labels", rows)
        if new.filter("moved").limit(1).count() == 0:
            return new.select("node", "component")
        labels = new.select("node", "component")
