"""Connected components of a link table, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ._store import attach, keep


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node and comp (the smallest node reachable) for every node of links (a, b).

    Large-star and small-star rounds (Kiveris et al., Connected Components in MapReduce and Beyond): each node links its
    larger neighbours, then its smaller ones, to the smallest node it knows. Both are a minimum by key and a join, so
    a node with very many neighbours is never gathered, and `attach` keeps its links apart. Rounds go on until the links no longer change;
    if they still do after `most_rounds`, an error is raised.
    """
    edges = keep(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    seen = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count(F.lit(1)).alias("n"))
        large = attach(both.where("b > a"), least, ["a"], "n").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b")
        small = small.select(F.col("m").alias("a"), "b").unionByName(small.select(F.col("m").alias("a"), F.col("a").alias("b"))).where("a < b").distinct()
        edges = keep(small, edges)
        now = tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"links still change after {most_rounds} rounds")
    leaves = edges.select(F.col("b").alias("node"), F.col("a").alias("comp"))
    return keep(leaves.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("comp")).distinct()), edges)
