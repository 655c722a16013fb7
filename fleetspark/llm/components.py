"""Connected components of an edge table, by hooking to minima and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every id of ``edges (a, b)``; the component is its smallest id.

    In each round a node takes its smallest neighbour (or itself) as parent,
    parents are followed to their end by doubling, and the edges move to those
    ends; inner edges go.  The smallest node of a component is always its own
    parent, so it is the one that remains.  Every step is a table written in the
    shared folder: lost executors cost a step at most.
    """
    live = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    live = saved(live)
    label: DataFrame | None = None
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("p"))
        parent = saved(parent)
        moving = True
        while moving:
            up = parent.select(F.col("a").alias("p"), F.col("p").alias("pp")).filter("p <> pp")
            step = saved(parent.join(up, "p", "left").select("a", F.coalesce("pp", "p").alias("p"), F.col("pp").isNotNull().alias("moved")))
            moving = not step.filter("moved").isEmpty()
            parent = step.select("a", "p")
        first = parent.select(F.col("a").alias("id"), F.col("p").alias("component"))
        if label is None:
            label = first
        else:
            step = parent.withColumnRenamed("a", "component")
            label = saved(label.join(step, "component", "left").select("id", F.coalesce("p", "component").alias("component")))
        moved = (live.join(parent, "a").select(F.col("p").alias("a"), "b")
                 .join(parent.select(F.col("a").alias("b"), F.col("p").alias("q")), "b").select("a", F.col("q").alias("b")))
        live = saved(moved.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if label is None:
        return edges.select(F.col("a").alias("id"), F.col("a").alias("component")).limit(0)
    return label
