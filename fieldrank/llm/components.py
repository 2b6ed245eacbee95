"""Connected components of an edge table, by contraction.

Each round every node hooks to its smallest neighbour (or stays), pointer jumping flattens
the trees, and the edges are redrawn between the roots. At least half of the nodes that
still have an edge disappear each round. Hot nodes are combined by partial aggregation; the
joins are plain equi-joins that adaptive execution can split. Every step is a written
table, so a lost executor costs no more than that step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame | None:
    """(node, root) of each node of ``edges`` (u, v: long), root the component's least
    node; None if there are no edges."""
    pairs = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), "edges")
    labels = None
    while not pairs.isEmpty():
        both = pairs.union(pairs.select("v", "u"))
        hooks = written(both.groupBy("u").agg(F.min("v").alias("v")).select(
            F.col("u").alias("node"), F.least("u", "v").alias("root")), "hooks")
        while True:
            above = hooks.select(F.col("node").alias("root"), F.col("root").alias("top"))
            jumped = written(hooks.join(above, "root").select("node", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved")), "jump")
            hooks = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            labels = hooks
        else:
            above = hooks.select(F.col("node").alias("root"), F.col("root").alias("top"))
            labels = written(labels.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "labels")
        mapped = pairs.join(hooks.select(F.col("node").alias("u"), F.col("root").alias("a")), "u") \
            .join(hooks.select(F.col("node").alias("v"), F.col("root").alias("b")), "v")
        pairs = written(mapped.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    return labels
