"""Connected components of a table of links, by large-star and small-star rounds.

A round joins each node to its smallest neighbour; sums and minima are pre-aggregated per task and the joins are plain
equi-joins that adaptive execution splits where one node has very many links.  Each round's table goes to the shared
folder, so lineage stays short; the number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links: (a, b) with a > b."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") > F.col("b")).distinct()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b) of longs, in any order -> (node, label) for every node with a link; label is the smallest node."""
    now = scratch.table(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") > F.col("b")).distinct(), "links-0")
    told = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before, k = told(now), 0
    while True:
        k += 1
        now = scratch.table(_star(_star(now, True), False), f"links-{k}")
        after = told(now)
        scratch.drop(f"links-{k - 1}")
        if after == before:
            break
        before = after
    # All links now lead from a node to the smallest of its component.
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
