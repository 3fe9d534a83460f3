"""Connected components of a graph that is far smaller than its corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from metricloom.llm.common import stored


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, comp): the smallest id of each component, for every linked id.

    Alternating large-star and small-star steps: every node is tied to the
    smallest neighbour it knows, until nothing moves. A step is one grouped
    minimum (folded before its shuffle, so a hub costs no more than its edge
    count) and one join; the number of steps grows with the logarithm of the
    component size. Each step's edges are written to the shared folder.
    """
    key = F.col(a) > F.col(b)
    edges = stored(
        links.where(F.col(a) != F.col(b))
        .select(F.when(key, F.col(a)).otherwise(F.col(b)).alias("u"),
                F.when(key, F.col(b)).otherwise(F.col(a)).alias("v")).distinct(),
        "edges",
    )
    mark = _mark(edges)
    while mark[0]:
        edges = stored(_small_star(_large_star(edges)), "edges")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("comp")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())


def _stars(pairs: DataFrame, keep: Column) -> DataFrame:
    """Each neighbour of a node tied to the node's smallest neighbour or itself."""
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return pairs.join(least, "u").where(keep)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _stars(both, F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    stars = _stars(edges, F.lit(True))
    tied = stars.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        stars.select("u", F.col("m").alias("v"))
    )
    return tied.where(F.col("u") != F.col("v")).distinct()
