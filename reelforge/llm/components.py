"""Connected components of a graph given by its edges."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelforge.operators.durable import settle
from reelforge.operators.joins import spread_join


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for each node that has an edge.

    ``edges`` has ``a`` and ``b`` of any type with an order. Large-star and small-star in turn: each round hangs nodes on
    smaller ones until every component is a star, in a number of rounds that grows as the logarithm squared of its size at most. Each round
    is stored; the driver sees a count and a checksum. Edges are never expanded to pairs.
    """
    def star(pairs: DataFrame) -> DataFrame:
        return spread_join(pairs, pairs.groupBy("u").agg(F.min("v").alias("m")), ["u"], "inner")  # a centre may have very many

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    held = settle(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while (now := state(held)) != before:
        before = now
        both = held.union(held.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        joined = star(large)
        held = settle(
            joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(joined.select("u", F.col("m").alias("v"))).distinct(), "edges")
    return held.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        held.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
