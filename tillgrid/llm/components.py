"""Connected components of links between documents, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrid.llm.common import stored

ROUNDS = 50
# So few links are stepped through in one task: no shuffle is worth its tasks then. The steps are the same.
FEW = 200_000


def components(links: DataFrame) -> DataFrame:
    """doc, component (the smallest doc reachable) for every document of ``links`` (a, b).

    A large-star step hangs all larger neighbours of a document on its smallest
    neighbour, a small-star step all smaller ones; smallest neighbours are found
    by an aggregate that combines before its shuffle. Links are written after
    each round; rounds grow with the logarithm of the longest chain. Not to be done
    after ``ROUNDS`` is an error.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    few, before = edges.count() <= FEW, None
    for _ in range(ROUNDS):
        edges = edges.coalesce(1) if few else edges
        both = edges.union(edges.select("v", "u"))
        both = both.coalesce(1) if few else both
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        edges = stored(small.select("e.u", "e.v").where("u <> v").distinct(), "links")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components still changed after {ROUNDS} rounds")
    own = edges.select(F.col("v").alias("doc")).distinct().select("doc", F.col("doc").alias("component"))
    return edges.select(F.col("u").alias("doc"), F.col("v").alias("component")).union(own)
