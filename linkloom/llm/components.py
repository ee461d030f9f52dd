"""Connected components of a link table, by alternating star contractions.

Each round is two grouped aggregations over (node, neighbour) rows: "large star" links every larger neighbour to
the least of a node's neighbourhood, "small star" links every smaller-or-equal one. The table is written to the
shared folder each round, so a lost executor costs one round at most. Rounds grow with the logarithm of the
longest chain. Nothing but two counters reaches the driver, and what its plans took is let go after each round, as a
driver's heap otherwise grows with the rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _least(rows: DataFrame) -> DataFrame:
    """(a, m): the least neighbour of each node, written. The neighbours of a node that many are linked to can then be dealt out:
    the table is sent to every task where its count proves it small, and beyond that Spark splits skewed joins of two scans."""
    return common.written(rows.groupBy("a").agg(F.min("b").alias("m")), "star-least")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    met = both.where("b > a").join(common.few(_least(both)), "a")
    return met.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).where("a != b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _least(down)
    met = down.join(common.few(least), "a")
    return met.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b of one orderable type, structs too) to (node, root): the least node of each component. A node
    without a link doesn't occur. It ends when a round changes nothing."""
    now = edges.select("a", "b").where("a is not null and b is not null and a != b").distinct()
    stamp = None
    while True:
        now = common.written(_small(common.written(_large(now), "star-half")), "star")
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        common.release(now.sparkSession)
        if stamp == tuple(seen):
            break
        stamp = tuple(seen)
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
