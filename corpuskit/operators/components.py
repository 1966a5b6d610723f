"""Connected components of an edge list that never leaves the cluster.

Each round every node takes the smallest label among its own, its neighbours' and its label's own label
(hooking and pointer jumping), so the number of rounds is about logarithmic in the diameter. Every round
is checkpointed to the shared folder; a lost executor costs a re-read, not the whole lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.session import cut_lineage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 50) -> DataFrame:
    """``node`` and ``component`` (the least node of it) for every node of an edge. Loops and repeats do no harm."""
    both = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x is not null and y is not null and x <> y")
    both = cut_lineage(both.union(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    labels = cut_lineage(both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("label")))
    for _ in range(max_rounds):
        near = both.join(labels.select(F.col("x").alias("y"), "label"), "y").groupBy("x").agg(F.min("label").alias("near"))
        hop = labels.select(F.col("x").alias("label"), F.col("label").alias("hop"))
        new = (
            labels.join(near, "x")
            .join(hop, "label", "left")
            .select("x", "label", F.least("label", "near", F.coalesce("hop", "label")).alias("new"))
        )
        new = cut_lineage(new)
        changed = new.filter("new <> label").limit(1).count()
        labels = new.select("x", F.col("new").alias("label"))
        if not changed:
            break
    else:
        raise RuntimeError(f"components did not settle within {max_rounds} rounds")
    return labels.select(F.col("x").alias("node"), F.col("label").alias("component"))
