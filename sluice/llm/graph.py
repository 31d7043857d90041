"""Connected components of an edge table, by contraction; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (v, root) for each vertex of an edge; root is the component's smallest vertex.

    Each round points every vertex at its smallest neighbour, follows the pointers to their ends by doubling, and
    contracts the edges onto those ends; at least half of the vertices that still have edges go each round.
    Every step is written to the shared folder, so a lost executor repeats one step at most.
    """
    edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges, labels = stored(edges, "edges"), None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parents = stored(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("p")).select("v", F.least("v", "p").alias("p")), "parents")
        while True:
            ends = parents.select(F.col("v").alias("p"), F.col("p").alias("pp"))
            jumped = stored(parents.join(ends, "p").select("v", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")), "parents")
            moved = not jumped.where("moved").isEmpty()
            parents = jumped.drop("moved")
            if not moved:
                break
        a, b = parents.select(F.col("v").alias("a"), F.col("p").alias("pa")), parents.select(F.col("v").alias("b"), F.col("p").alias("pb"))
        met = edges.join(a, "a").join(b, "b").where("pa <> pb")
        edges = stored(met.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
        if labels is None:
            labels = parents.select("v", F.col("p").alias("root"))
        else:
            last = parents.select(F.col("v").alias("root"), "p")
            labels = stored(labels.join(last, "root", "left").select("v", F.coalesce("p", "root").alias("root")), "labels")
    return labels if labels is not None else edges.select(F.col("a").alias("v"), F.col("b").alias("root"))
