"""Connected components of a large graph by repeated contraction.

Each round every node is merged into the smallest neighbour under a round's own
pseudo-random order, and the edges are rewritten between the merged nodes.  The
order is redrawn each round, so long paths shrink by a constant factor and the
number of rounds is logarithmic.  All joins put one row per node against the
edges, and every intermediate is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import written


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) for every node of ``edges(u, v)``; nodes of one component
    share a label, which is one of its nodes.  Self loops, repeated and reversed
    edges are allowed; an empty edge table gives an empty result."""
    key = edges.schema["u"].dataType
    edges = written(edges.where("u <> v").distinct(), f"{name}-edges")
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        n = len(rounds)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(n), F.col(c)).alias("r"), F.col(c).alias("id"))
        parent = (both.groupBy("u").agg(F.min(rank("v")).alias("m"))
                  .select(F.col("u").alias("node"), F.least("m", rank("u"))["id"].alias("parent")))
        parent = written(parent, f"{name}-parents")
        rounds.append(parent)
        left = parent.select(F.col("node").alias("u"), F.col("parent").alias("pu"))
        right = parent.select(F.col("node").alias("v"), F.col("parent").alias("pv"))
        merged = edges.join(left, "u").select("v", "pu")
        merged = merged.join(right, "v").where("pu <> pv")
        edges = written(merged.select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct(),
                        f"{name}-edges")
    if not rounds:
        return edges.select(F.col("u").alias("node"), F.col("v").cast(key).alias("label"))
    labels = rounds[-1].withColumnRenamed("parent", "label")
    for parent in reversed(rounds[:-1]):
        later = labels.select(F.col("node").alias("parent"), "label")
        labels = (parent.join(later, "parent", "left")
                  .select("node", F.coalesce("label", "parent").alias("label")))
        labels = written(labels, f"{name}-labels")
    return labels
