"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); a component is named by its smallest node.

    Alternates two steps until nothing changes: each node hands its larger neighbours to its smallest one, then its
    smaller neighbours. Each step is an aggregate with map-side combining and a join whose large side can be split, so
    a node with very many links is no special case. Rounds grow with the logarithm of the longest path. Every round is
    a written table, so a lost executor costs a task and not the run.
    """
    edges = materialize(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    last = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(large.distinct())
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        down = edges.join(least, "u")
        small = down.select("u", F.col("m").alias("v")).union(down.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = materialize(small.distinct())
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return materialize(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots))
