"""Connected components of a table of links, by joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, saved


def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node that can be reached from each node of the links (a, b).

    Large-star and small-star rounds alternate: a round hangs a node's larger, then its other neighbours on the least
    one, until every link points from a node to the least of its component. A round is an aggregate by node, combined
    before it is shuffled, and a join that Spark splits at nodes with very many links; links are written after each
    round, so no plan grows and a lost executor costs one round at most.
    """
    now = saved(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars")
    before = None
    while (mark := now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()) != before:
        before = mark
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = saved(large, "stars")
        # a node and its smaller neighbours all go under the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select("m", F.explode(F.array("a", "b")).alias("a")).select("a", F.col("m").alias("b"))
        was, now = now, saved(small.where("a <> b").distinct(), "stars")
        forget(was, large)
    top = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(top.select("node", F.col("node").alias("label")))
