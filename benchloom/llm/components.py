"""Connected components of a table of links, by alternating star operations.

Every round points the larger neighbours of a node at its smallest one, then the smaller
neighbours; after few rounds each node points at the smallest node of its component.  The links
stay in tables: only their number and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .folders import discard, store


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    larger = both.where("b > a").join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    smaller = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return smaller.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(links: DataFrame) -> tuple:
    # a decimal sum: 64-bit hashes of many links would overflow a long
    total = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    return tuple(links.agg(F.count("*"), total).first())


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of links ``a, b``; the root is the smallest node reachable.

    Links may repeat or join a node to itself.  A node without a link to another has no row.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    links, folder = store(links, "links")
    mark = _mark(links)
    while mark[0]:
        last = folder
        links, folder = store(_small_star(_large_star(links)), "links")
        discard(links.sparkSession, last)
        before, mark = mark, _mark(links)
        if mark == before:
            break
    # roots point nowhere; they are the ends of the links
    found = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
