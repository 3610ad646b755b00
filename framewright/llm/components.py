"""Connected components over an edge table, as Spark joins with written rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store


def components(edges: DataFrame) -> DataFrame:
    """(node, component) with the smallest node that each node of ``edges`` (a, b) reaches.

    Each round links every node to its smallest neighbour (large star, then small star);
    chains halve, so a component of n nodes takes about log n rounds.  Hot nodes are
    only aggregated (partial minimum first) and joined, never gathered.  No edges give
    no rows; self loops and repeated edges are allowed.
    """
    spark = edges.sparkSession
    pairs = store.cut(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(),
        "edges",
    )
    while not _stars(pairs):
        # minima are written before they are joined: a hub's rows can then be split
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = store.cut(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        large = store.cut(large, "large")
        low2 = store.cut(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        ends = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
        small = large.join(low2, "u").select(ends.alias("e")).select("e.*").where("u > v").distinct()
        after = store.cut(small, "star")
        for old in (pairs, low, large, low2):
            store.drop(spark, old)
        pairs = after
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _stars(pairs: DataFrame) -> bool:
    """Every node has one smaller neighbour, which has none: nothing is left to do."""
    ends = F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up")), F.struct(F.col("v").alias("x"), F.lit(0).alias("down"), F.lit(1).alias("up"))))
    seen = pairs.select(ends.alias("e")).groupBy("e.x").agg(F.sum("e.down").alias("down"), F.max("e.up").alias("up"))
    return seen.where("down > 1 or down = 1 and up = 1").limit(1).count() == 0
