"""Connected components of an edge table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.session import settle


def components(edges: DataFrame) -> DataFrame:
    """(id, label) for every end of the edges (a, b): label is the least id of its component.

    Every round a node takes the least label of itself, its neighbours and its label's own node, so labels travel
    along the edges and jump along what was found before. Each round is written to the shared folder. An empty edge
    table gives no rows; loops and repeated edges are harmless; nulls are dropped.
    """
    clean = edges.select("a", "b").where("a is not null and b is not null and a <> b")
    both = settle(clean.union(clean.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = settle(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("label")), "labels")
    while True:
        told = both.join(labels, both.a == labels.id).select(F.col("b").alias("id"), "label")
        over = labels.select("id", F.col("label").alias("at")).join(labels.select(F.col("id").alias("at"), "label"), "at")
        least = told.union(over.select("id", "label")).groupBy("id").agg(F.min("label").alias("new"))
        nxt = settle(labels.join(least, "id").select("id", F.least("label", "new").alias("label"), (F.col("new") < F.col("label")).alias("moved")), "labels")
        labels = nxt.select("id", "label")
        if not nxt.where("moved").limit(1).count():
            return labels
