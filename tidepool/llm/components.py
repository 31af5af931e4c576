"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import pin


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Link every larger (or, for ``small``, every smaller) neighbour of a node to the least of them all."""
    if small:
        seen = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        seen = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    seen = seen.filter("u != v")
    least = seen.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    if not small:
        linked = seen.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        linked = (seen.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
                  .union(least.select("u", "m")))
    return linked.filter("a != b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) reaches; nodes without links are absent.

    Each round is two aggregations and joins on a node; the table of links is written between rounds. Rounds
    grow with the logarithm of the longest chain.
    """
    links = pin(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                "links")
    while True:
        after = pin(_star(pin(_star(links, small=False), "large"), small=True), "small")
        same = (links.withColumn("w", F.lit(1)).union(after.withColumn("w", F.lit(-1)))
                .groupBy("a", "b").agg(F.sum("w").alias("w")).filter("w != 0").isEmpty())
        links = after
        if same:
            break
    roots = links.groupBy(F.greatest("a", "b").alias("node")).agg(F.min(F.least("a", "b")).alias("root"))
    return roots.union(roots.select(F.col("root"), F.col("root"))).distinct()
