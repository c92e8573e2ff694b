"""Connected components over link tables, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.common import drop_staged, staged


def _large_star(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours link to the smallest node it knows."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours link to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return joined.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(links: DataFrame) -> DataFrame:
    """The number of links and a sum over them that tells two rounds apart; a sum of longs could overflow."""
    return links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node with a link; ``root`` is the smallest node of its component.

    ``links`` has columns ``a`` and ``b`` (long). Each round is two aggregations with a map-side combine and two joins
    that split hot nodes; its links are written to the shared folder. Rounds end when a round changes nothing, after
    about the logarithm of the longest chain.
    """
    now = staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    before = None
    while True:
        state = _state(now).first()
        if state == before or state[0] == 0:
            break
        before = state
        following = staged(_small_star(_large_star(now)), "links")
        drop_staged(now)
        now = following
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
