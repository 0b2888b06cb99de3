"""Connected components of a list of links, entirely on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridewright.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): the smallest node that it is joined to.

    Each round merges every node into the least of itself and its neighbours, and links that fall together
    are dropped, so links shrink from round to round. Keys are digests, in random order, so a chain loses a
    constant share of its nodes in each round and the rounds follow the logarithm of its length. The merges
    are then followed backwards. Rounds are written to the shared folder.
    """
    merges: list[DataFrame] = []
    left = links.select("a", "b").where("a <> b")
    while True:
        ends = left.select(F.col("a").alias("node"), F.col("b").alias("other")).union(left.select("b", "a"))
        into = ends.groupBy("node").agg(F.min("other").alias("other"))
        merges.append(stored(into.select("node", F.least("node", "other").alias("label")), "merges"))
        for end in ("a", "b"):
            merged = merges[-1].select(F.col("node").alias(end), F.col("label").alias(f"{end}_label"))
            left = left.join(merged, end)
        left = left.select(F.least("a_label", "b_label").alias("a"), F.greatest("a_label", "b_label").alias("b"))
        left = stored(left.where("a <> b").distinct(), "links")
        if not left.limit(1).count():
            break
    labels = merges.pop()
    while merges:
        last = labels.select(F.col("node").alias("label"), F.col("label").alias("root"))
        labels = merges.pop().join(last, "label", "left").select("node", F.coalesce("root", "label").alias("label"))
    return stored(labels, "labels")
