"""Connected components of a link table, by alternating large and small stars.

Every step is a group minimum (combined in the map tasks) and a join of the links with the stored
minima, so that the many links of one vertex can be split over tasks. Links and minima live in the
shared folder; nothing but a line of totals per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsight.llm.common import kept


def _least_neighbour(links: DataFrame) -> DataFrame:
    return kept(links.groupBy("u").agg(F.min("v").alias("m")), "least")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least_neighbour(both).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = _least_neighbour(links)
    moved = links.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected(links: DataFrame) -> DataFrame:
    """(vertex, root) for every vertex of the links (a, b), the root being its component's least
    vertex; roots are not listed. Loops and repeated links do no harm."""
    now = kept(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links")
    seen = None
    while True:
        state = now.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")),
            F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first()
        if state == seen or not state[0]:
            return now.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
        seen = state
        now = kept(_small_star(kept(_large_star(now), "links")), "links")
