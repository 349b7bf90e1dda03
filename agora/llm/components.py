"""Connected components by alternating large-star and small-star steps.

Edges are rows of two node ids. A large-star step links every larger neighbour
of a node to the least node around it; a small-star step does so with the node
and its smaller neighbours. Both keep components and leave, in few rounds,
stars whose centre is the least node. Every round is written to the shared
folder. Nodes with many neighbours are reduced in the map tasks, and the join
that hands them their centre is one Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.llm.shared import stored


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    centre = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(centre, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    centre = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(centre, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(centre.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b); component is the least id reachable.

    Repeated links and links of a node to itself change nothing; a link with a
    null end is none. Nodes that are only linked to themselves are left out.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stored(edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("u") != F.col("v"))).distinct(), "edges")
    state = None
    while True:
        edges = stored(small_star(large_star(edges)), "edges")
        # Two numbers tell whether the set of edges still changes.
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())
        state = now
