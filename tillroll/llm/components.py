"""Connected components of a graph given by its edges, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every end of the edges (a, b); a component is named
    by its smallest id.

    Each round joins every node with the smallest label around it, then with
    the label of that label, which halves the depth of what is left. A node
    with very many neighbours is pre-aggregated before each shuffle, and the
    joins are plain equi-joins, whose hot keys Spark splits. Each round is
    written to the shared folder, so lost executors don't recompute earlier
    ones. Only a count of changed labels reaches the driver.
    """
    both = written(
        edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "cc-edges",
    )
    labels = written(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("component")), "cc-labels")
    while True:
        around = both.join(labels, both["b"] == labels["id"]).groupBy(both["a"].alias("id")).agg(F.min("component").alias("near"))
        nearer = labels.join(around, "id").select(
            "id", F.col("component").alias("before"), F.least("component", "near").alias("component")
        )
        up = labels.select(F.col("id").alias("root"), F.col("component").alias("above"))
        stepped = written(
            nearer.join(up, nearer["component"] == up["root"]).select("id", "before", F.least("component", "above").alias("component")),
            "cc-labels",
        )
        changed = stepped.where("component <> before").limit(1).count()
        labels = stepped.select("id", "component")
        if not changed:
            return labels
