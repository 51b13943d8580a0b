"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridepulse.llm.common import stored


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    linked = e.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return linked.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, name: str) -> DataFrame:
    """``links`` (u long, v long, any order) as (node, root): root is the smallest node that reaches node.

    Roots themselves are not listed. Each round is stored in the shared work
    folder; the number of rounds grows with the logarithm of the longest
    chain. Only two counts come to the driver.
    """
    e = stored(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name
    )
    while True:
        inner = e.select(F.col("v").alias("u")).distinct().join(e, "u", "left_semi").limit(1).count()
        split = e.groupBy("u").count().where("count > 1").limit(1).count()
        if not inner and not split:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        e = stored(_small_star(_large_star(e).distinct()), name)
