"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node that has a link to another; the root is the smallest node that it reaches.

    ``links`` has the columns ``a, b``. Links are moved to ever smaller neighbours in turn (large star, small star)
    until nothing changes; each round is a written table, and only its row count and checksum reach the driver.
    """
    edges = written(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    while True:
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = now
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).unionAll(
            edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(least, "x").filter("y > x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = written(small.select("e.u", "e.v").filter("u <> v").distinct())
