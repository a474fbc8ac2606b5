"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

#: Links of a task in each round; no fewer tasks than cores.
LINKS_PER_TASK = 50_000


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, root`` of every end of a link; the root is the smallest id reachable.

    Each round hangs the larger neighbours of every id, then the smaller ones, on the smallest.
    Minima are formed before the shuffle, so a hub with most links is one row per task; the
    number of rounds grows with the logarithm of the longest chain. Each round is checkpointed. Tasks
    follow the links, not the session's shuffle partitions: few links in many files cost a block of disk each.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    edges = cut(links.filter(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct())
    tasks = max(links.sparkSession.sparkContext.defaultParallelism, -(-edges.count() // LINKS_PER_TASK))
    edges, before = edges.coalesce(tasks), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.coalesce(tasks).distinct().coalesce(tasks)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .filter("u <> v").coalesce(tasks).distinct()
        )
        edges = cut(small.coalesce(tasks))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("id")).distinct().withColumn("root", F.col("id"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(roots)
