"""Connected components of an edge table, by rounds of local contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.stored import stored


def components(edges: DataFrame) -> DataFrame:
    """Root of each node of an edge table ``(a, b)``: rows ``(node, root)``, a root being some node of the component.

    Each round gives every node a fresh rank, a hash of the node and the round, lets it join the lowest-ranked of itself and its
    neighbours, and rewrites the edges between what is left; a constant share of nodes goes in each round, whatever the
    shape of the graph. Only minima are gathered per node, so a node with very many edges is combined before the
    shuffle. Every round is written to the shared folder, which cuts lineage; nothing is brought to the driver. Edges with
    a null end or from a node to itself are dropped; an empty table gives an empty table.
    """
    edges = edges.select("a", "b").where("a <> b")
    left = stored(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    schema = left.schema["a"].dataType
    rounds = []
    while not left.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(F.lit(len(rounds)), c).alias("h"), c.alias("n"))
        lowest = left.groupBy("a").agg(F.min(rank(F.col("b"))).alias("m"))
        moved = stored(lowest.select(F.col("a").alias("node"), F.least("m", rank(F.col("a"))).getField("n").alias("root")), "moved")
        rounds.append(moved)
        at = lambda end: moved.select(F.col("node").alias(end), F.col("root").alias(f"to_{end}"))
        left = stored(
            left.join(at("a"), "a").join(at("b"), "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).where("a <> b").distinct(),
            "edges",
        )
    if not rounds:
        return left.select(F.col("a").cast(schema).alias("node"), F.col("b").cast(schema).alias("root"))
    labels = rounds[-1]
    for moved in reversed(rounds[:-1]):
        later = labels.select(F.col("node").alias("root"), F.col("root").alias("later"))
        labels = moved.join(later, "root", "left").select("node", F.coalesce("later", "root").alias("root"))
    return stored(labels, "roots")
