"""Connected components of a graph of links, by labels that fall to the smallest and jump along themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept


def components(links: DataFrame) -> DataFrame:
    """node, label for every end of a link (a, b): the label is the smallest node that links reach.

    Each round every node takes the smallest label next to it, then the label of its label; so a
    chain of n links needs about log n rounds. Minima combine before the shuffle, so a node with very many
    links gathers nothing. Rounds are written to the shared folder. Self-links and repeats do no harm.
    """
    edges = kept(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct())
    labels = kept(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")))
    while True:
        near = edges.join(labels, edges["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lowered = labels.join(near, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        over = lowered.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = kept(
            lowered.join(over, "label", "left").select("node", F.least("label", F.coalesce("next", "label")).alias("label"), "old")
        )
        changed = not jumped.where("label <> old").isEmpty()
        labels = jumped.select("node", "label")
        if not changed:
            return labels
