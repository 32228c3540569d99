"""Connected components of a graph given by edges, smallest id first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.llm.common import keep_in


def components(edges: DataFrame) -> DataFrame:
    """`node` and `component`, the smallest node reachable, for every node of `edges` (`u`, `v`: long).

    Alternates two rewritings until nothing changes: every node's larger neighbours are tied to its
    smallest one, then its smaller neighbours are. Each keeps the components and shortens paths, so
    the rounds grow with the logarithm of a component's width. Aggregations combine before they
    shuffle and joins can be split, so a node with very many edges is no single task's work. Each
    round is written to the shared folder.
    """
    edges = keep_in(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        edges = keep_in(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    tied = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return tied.unionByName(roots)
