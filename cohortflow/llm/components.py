"""Connected components of links between documents, as joins over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortflow.llm.text import stored


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest reachable node) for every node of ``links`` (a, b).

    Each round takes the smallest label among a node's neighbours and then the label of that label, so that long chains
    shorten by powers of two. Nothing but a count of changes reaches the driver; a node with very many links is summed on
    the map side. No links give no rows.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(both.distinct(), "links")
    state = stored(edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")), "labels")
    while True:
        near = edges.join(state.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("_near"))
        hooked = stored(state.join(near, "node").select("node", "component", F.least("component", "_near").alias("_next")), "hooks")
        parents = hooked.select(F.col("node").alias("_next"), F.col("_next").alias("_root"))
        jumped = hooked.join(parents, "_next").select("node", F.least("_next", "_root").alias("_new"), "component")
        rows = stored(jumped, "labels")
        changed = rows.filter("_new <> component").limit(1).count()
        state = rows.select("node", F.col("_new").alias("component"))
        if not changed:
            return state
