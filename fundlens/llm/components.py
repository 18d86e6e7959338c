"""Connected components of an undirected edge table.

Rounds of large-star and small-star steps: every node links its larger
neighbours, then its smaller ones, to its smallest neighbour, until each
component is a star around its smallest node.  The number of rounds grows with
the logarithm of the longest path.  Each round's edges are written to the
shared checkpoint folder, which cuts the lineage; a step shuffles the edges by
node, takes a minimum with map-side combining and joins it back, so a node with
many neighbours is never gathered in one group (AQE splits a skewed join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.llm.frames import stored


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Edges (u, v) as directed pairs to link to u's smallest neighbour."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    linked = edges.join(least, F.col("u") == F.col("k"))
    if larger:  # u's larger neighbours
        return linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.where("m < k").select(F.col("k").alias("u"), F.col("m").alias("v"))
    return linked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(own)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node in
    ``edges`` (a, b)."""
    edges = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .where("u <> v").distinct(), "edges")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = stored(_star(both, larger=True).where("u <> v").distinct(), "edges")
        edges = stored(_star(edges, larger=False).where("u <> v").distinct(), "edges")
        seen = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).head()
        if state == seen:
            break
        state = seen
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
