"""Connected components of a large undirected graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerq.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``: its component's smallest node.

    Alternates two star steps: each node hands its larger, then its smaller neighbours to the smallest
    one it knows, so that long chains shrink by halves. Only pairs of keys move. Smallest neighbours are
    aggregates that combine before the shuffle, a node with many neighbours is a skewed join side that
    AQE splits, and every round is written out once. Null and self links are ignored; no links, no rows.
    """
    links = cut(
        edges.where("a is not null and b is not null and a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = cut(
            both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large"
        )
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .where("b != m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b")))
            .distinct()
        )
        small = cut(small, "small")
        # Done when the links are stars: no smaller end is itself tied to something smaller.
        if small.join(small.select(F.col("a").alias("b")).distinct(), "b", "left_semi").isEmpty() and (
            small.groupBy("a").count().where("count > 1").isEmpty()
        ):
            roots = small.select(F.col("b").alias("node")).distinct()
            return small.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                roots.select("node", F.col("node").alias("root"))
            )
        links = small
