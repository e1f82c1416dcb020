"""Connected components of an edge table, by alternating stars.

Large-star links the larger neighbours of a node to the smallest node around
it, small-star the smaller ones; in turn they make a star of every component
in a logarithmic number of rounds. A node's neighbours are never gathered: the
smallest comes from an aggregate and is joined back, and adaptive execution can
split that join at a hub. Each round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histkit.sources.tables import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node with an edge in ``edges`` (a, b: bigint); the root is the smallest node."""
    now, mark = stage(_tidy(edges.select("a", "b"))), None
    while True:
        now = stage(_tidy(_small_star(_tidy(_large_star(now)))))
        told = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if told == mark:
            break
        mark = told
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stage(stars.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
