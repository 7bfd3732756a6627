"""Connected components of a link table, by iterated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.upkeep import Workspace


def connected_components(links: DataFrame, space: Workspace | None = None) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a, b``, any direction, may repeat).

    The component is its smallest node. Each round gives every node the smallest label among
    its neighbours (combined before the shuffle, so a node with very many links is no more
    than one row a task) and then follows labels to the labels of their labels, which halves
    distances. Rounds are written to the shared folder; they end when no label changes.

    Defined cases: a link of a node with itself, or one with a null end, links nothing and gives
    no row; links may repeat; other columns are not read; no links give no rows. Nodes may be
    of any type that can be ordered.
    """
    staged = (space or Workspace(links.sparkSession, "components")).staged
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")
    edges = staged(both.distinct(), "edges")
    labels = staged(edges.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("component")
    ), "labels")
    while True:
        near = edges.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("near"))
        lowered = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.least("component", "near").alias("reached"), F.col("component").alias("old")
        )
        hop = lowered.select(F.col("node").alias("via"), F.col("reached").alias("further"))
        jumped = staged(
            lowered.join(hop, F.col("reached") == F.col("via"), "left").select(
                "node", F.least("reached", F.coalesce("further", "reached")).alias("component"), "old"
            ), "labels",
        )
        labels = jumped.select("node", "component")
        if jumped.where("component <> old").isEmpty():
            return labels
