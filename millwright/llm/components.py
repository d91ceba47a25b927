"""Connected components of a link table by alternating star contraction.

Every step is a join and an aggregation on Spark; links never visit the driver. The link
table of each round is written to the shared scratch folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.session import written


def _large_star(links: DataFrame) -> DataFrame:
    """Each node hangs its larger neighbours on the smallest node of its neighbourhood."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node hangs itself and its smaller neighbours on the smallest of them; here ``a < b``."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    hung = links.join(least, "b").where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return hung.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node with a link; ``links`` has columns a, b of one ordered type.

    root is the smallest node reachable. Self links and repeated links don't matter, nulls are ignored.
    """
    now = written(links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    state = _state(now)
    while True:
        now = written(_small_star(_large_star(now)), "links")
        before, state = state, _state(now)
        if before == state:
            break
    roots = now.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(roots)
