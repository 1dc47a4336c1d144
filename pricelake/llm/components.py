"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import stage
from pricelake.session import discard


def _least_neighbour(links: DataFrame) -> DataFrame:
    """``u`` with ``least``, the smallest of itself and its neighbours."""
    return links.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("least"))


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) for every node of ``links`` (``a``, ``b``).

    Large stars and small stars in turn: every round hangs neighbours onto smaller nodes until all hang onto the
    smallest. A link becomes at most one link, so the table never grows, however large a component is; the number of rounds grows
    with the logarithm of its length. No links give no rows. Each round is written to the shared folder, which cuts the lineage.
    """
    spark = links.sparkSession
    links, path = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    state = None
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: larger neighbours go to the smallest one.
        # The smallest neighbours are written out: of two plain sides adaptive execution can split a hub.
        least, large_least_path = stage(_least_neighbour(both), "least-neighbours")
        large = both.where("v > u").join(least, "u")
        large = large.select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        large, large_path = stage(large, "large-star")
        # Small star: a node and its smaller neighbours go to the smallest of them.
        least, small_least_path = stage(_least_neighbour(large), "least-neighbours")
        small = large.join(least, "u").where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        small = small.unionAll(least.select("u", F.col("least").alias("v"))).distinct()
        following, following_path = stage(small, "small-star")
        discard(spark, path, large_path, large_least_path, small_least_path)
        links, path = following, following_path
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionAll(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
