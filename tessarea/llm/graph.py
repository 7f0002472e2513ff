"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessarea.session import Scratch


def components(links: DataFrame, scratch: Scratch, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b), the root the smallest node of its component.

    A large star hangs a node's larger neighbours on its smallest neighbour, a small star its smaller ones; edges stay as many
    as they were at most, and the rounds grow with the logarithm of the nodes. Each round is written, so none is computed twice."""
    edges = scratch.keep(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = scratch.keep(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        scratch.drop(edges)
        edges = new
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("the components have not settled")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
