"""Connected components of an edge table, by contraction, without collecting anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stored


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every id of ``edges(a, b)``; a component is named by its smallest id.

    Each round points every id at its smallest neighbour and contracts the edges to what the ids point at. An id with very many
    neighbours costs no more than a few: minima are taken before the exchange, and AQE splits its rows in the joins.
    """
    edges = stored(edges.where("a is not null and b is not null and a <> b").select("a", "b"))
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to")).withColumnRenamed("a", "id"))
        if labels is None:
            labels = step.select("id", F.col("to").alias("component"))
        else:
            moved = labels.join(step.withColumnRenamed("id", "component"), "component", "left")
            labels = stored(moved.select("id", F.coalesce("to", "component").alias("component")))
        left = edges.join(step.select(F.col("id").alias("a"), F.col("to").alias("x")), "a")
        pairs = left.join(step.select(F.col("id").alias("b"), F.col("to").alias("y")), "b").where("x <> y")
        edges = stored(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if labels is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return labels
