"""Connected components of a graph given as links, by alternating stars.

After Kiveris et al., "Connected components in MapReduce and beyond" (2014): the large star links the
larger neighbours of each node to its smallest one, the small star the smaller ones, until nothing
changes.  Every step is written to the shared folder; no node's neighbours meet in one task, as the
smallest one is found by an aggregate that is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumora.plans.freeze import freeze


def _state(links: DataFrame):
    return links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """(u, label): each node that has a link (columns u, v: longs), and the smallest node reachable."""
    def pairs(x, y):
        return F.greatest(x, y).alias("u"), F.least(x, y).alias("v")

    links = freeze(links.filter("u <> v").select(*pairs(F.col("u"), F.col("v"))).distinct())
    state = _state(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = freeze(both.filter("v > u").join(freeze(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .filter("u <> v").distinct())
        smaller = freeze(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(smaller, "u").select("u", "v", "m")
        links = freeze(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .unionByName(smaller.select("u", F.col("m").alias("v"))).select(*pairs(F.col("u"), F.col("v")))
                       .filter("u <> v").distinct())
        before, state = state, _state(links)
        if state == before:
            break
    return links.groupBy("u").agg(F.min("v").alias("label")).unionByName(
        links.select(F.col("v").alias("u"), F.col("v").alias("label")).distinct())
