"""Connected components of links, by turns of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.cluster import stored

#: Turns are logarithmic in a component's length; so many mean that something is wrong.
MOST_TURNS = 60


def components(links: DataFrame) -> DataFrame:
    """``links`` has long columns u and v. One row per node that has a link to another: node, root (its component's smallest node).

    Each turn replaces a node's links by links to the smallest node among them. Minima are aggregated before
    they are shuffled and joined back, so a node with very many links is a skewed join, never one group.
    """

    def neat(df: DataFrame) -> DataFrame:
        return df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = stored(neat(links), "links")
    seen = state(edges)
    for _ in range(MOST_TURNS):
        if not seen[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = neat(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = stored(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.withColumnRenamed("m", "v"))
        edges = stored(neat(small), "links")
        before, seen = seen, state(edges)
        if before == seen:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
