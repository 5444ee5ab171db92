"""Connected components of a link table by contraction: hook to the smallest neighbour, shorten, relabel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its smallest node.

    Each round every node hooks to its smallest neighbour if that is smaller, chains of hooks are shortened to their ends,
    and links are rewritten between the ends, so at least half of the nodes that still have links leave. Neighbours are
    reduced to their minimum before the shuffle, so a node with very many links is one row per task.
    No links give an empty result; links of a node to itself are kept as single nodes.
    """
    links = written(links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).distinct(), "links")
    labels = None
    open_links = links.filter("a <> b")
    while not open_links.isEmpty():
        both = open_links.union(open_links.select("b", "a"))
        hooks = both.groupBy("a").agg(F.min("b").alias("to")).select(F.col("a").alias("node"), F.least("a", "to").alias("to"))
        hooks = written(_shortened(hooks), "hooks")
        if labels is None:
            labels = hooks.withColumnRenamed("to", "component")
        else:
            far = hooks.select(F.col("node").alias("component"), "to")
            labels = labels.join(far, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        labels = written(labels, "labels")
        left, right = hooks.toDF("a", "to_a"), hooks.toDF("b", "to_b")
        open_links = open_links.join(left, "a").join(right, "b").filter("to_a <> to_b")
        open_links = written(open_links.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "links")
    alone = links.select(F.col("a").alias("node"))
    if labels is None:
        return alone.distinct().withColumn("component", F.col("node"))
    alone = alone.distinct().join(labels.select("node"), "node", "left_anti")
    return labels.unionByName(alone.withColumn("component", F.col("node")))


def _shortened(hooks: DataFrame) -> DataFrame:
    """Every node hooked to the end of its chain; chains only go down, so they end."""
    while True:
        hooks = written(hooks, "hooks")
        onward = hooks.select(F.col("node").alias("to"), F.col("to").alias("next")).filter("next <> to")
        if hooks.join(onward, "to", "left_semi").isEmpty():
            return hooks
        hooks = hooks.join(onward, "to", "left").select("node", F.coalesce("next", "to").alias("to"))
