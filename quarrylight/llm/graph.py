"""Connected components over an edge table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns node, component (its least node) for each node of edges.

    Each round a node takes the least label around it and then the label of that label, so that long chains
    shrink by powers; the labels are written to the shared folder each round, which keeps the plan short and
    survives lost executors. Stops when no label changes. Null ends and loops are left out.
    """
    pairs = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x is not null and y is not null and x <> y")
    both = materialize(pairs.select(F.explode(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))).alias("e")).select("e.x", "e.y").distinct(), "edges")
    labels = materialize(both.groupBy(F.col("x").alias("node")).agg(F.least(F.col("node"), F.min("y")).alias("component")), "labels")
    while True:
        around = both.join(labels.select(F.col("node").alias("y"), "component"), "y").groupBy(F.col("x").alias("node")).agg(F.min("component").alias("near"))
        hooked = labels.join(around, "node", "left").select("node", F.col("component").alias("old"), F.least("component", "near").alias("up"))
        jumped = hooked.join(labels.select(F.col("node").alias("up"), F.col("component").alias("top")), "up", "left").select("node", "old", F.least("up", "top").alias("component"))
        new = materialize(jumped, "labels")
        labels = new.select("node", "component")
        if new.filter("old <> component").isEmpty():
            return labels
