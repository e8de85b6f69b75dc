"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffmart.llm.common import moved, written


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b): the smallest node that its links reach.

    Each round ties every node's larger neighbours to the smallest one it sees, then its smaller ones, until the links
    are stars; the number of rounds grows with the logarithm of the longest chain. Each round is written, so a lost
    executor costs one round at most. Minima are added up before the shuffle, so a hub's neighbours do not meet in one
    task; they meet its minimum in an equi join.
    """

    def smallest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))

    def mark(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    kept = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = mark(kept)
    for _ in range(most_rounds):
        both = kept.union(kept.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(moved(smallest(both)), "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        # the plan of the second star reads the first one twice, so it is written too
        large = written(large, "large-star")
        mins = smallest(large)
        small = large.join(moved(mins), "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        kept = written(small.union(mins.select("a", F.col("least").alias("b"))).distinct(), "small-star")
        now = mark(kept)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("links did not settle")
    roots = kept.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
