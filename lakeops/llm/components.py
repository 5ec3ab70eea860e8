"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import settled


def _starred(links: DataFrame) -> DataFrame:
    """Both steps: larger neighbours, then smaller ones, move to the smallest node around."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    large = large.where("a != b").distinct()
    least = large.groupBy("a").agg(F.min("b").alias("least"))
    moved = large.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.withColumnRenamed("least", "b")).where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node but the roots: ``root`` is the smallest node of its component.

    ``links`` has two bigint columns ``a`` and ``b``; direction and repeats do not matter. Each
    round groups and joins by node, its result goes to the shared checkpoint folder, and a checksum
    tells when nothing moves any more. Rounds grow with the logarithm of a component's width.
    """
    links = settled(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .where("a != b").distinct())
    seen = None
    while True:
        state = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state[0] == 0 or state == seen:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
        links = settled(_starred(links))
