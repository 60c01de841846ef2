"""Connected components of a two-sided graph, by joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerq.sources.workspace import cut


def components(edges: DataFrame, node: str, link: str, label: str = "grupo") -> DataFrame:
    """``node, label`` where two nodes share a label when a chain of links connects them.

    Each round a node takes the lowest label seen over its links, hands it to the node its old
    label names, and then follows its label one step, so long chains shrink by halves. Only
    narrow rows move; aggregates combine before the shuffle and AQE splits a link that many nodes
    share. Every round is written out once.
    """
    labels = edges.select(node, F.col(node).alias(label)).distinct()
    while True:
        per_link = edges.join(labels, node).groupBy(link).agg(F.min(label).alias("_low"))
        seen = edges.join(per_link, link).groupBy(node).agg(F.min("_low").alias("_low"))
        step = cut(labels.join(seen, node), "components")
        if step.where(F.col("_low") < F.col(label)).isEmpty():
            return step.select(node, label)
        offers = step.select(node, "_low").unionByName(step.select(F.col(label).alias(node), "_low"))
        lower = offers.groupBy(node).agg(F.min("_low").alias("_low"))
        labels = lower.join(lower.select(F.col(node).alias("_low"), F.col("_low").alias(label)), "_low").select(
            node, label
        )
