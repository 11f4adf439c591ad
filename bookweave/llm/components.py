"""Connected components by contraction, in DataFrame code.

Each round every node hooks to its smallest neighbour, chains of hooks are shortened by two pointer jumps, and the
edges are rewritten to the new labels; edges inside a label go. Long paths and stars alike take logarithmically many
rounds. Every round is written to the shared folder. A node with very many edges is pre-aggregated (min), and the
joins put a written table with one row per key against the edges, so Spark can split hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """edges(a, b) -> (node, label): label is the smallest node that edges connect with; nodes without edges have no row."""
    edges = scratch.write(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = scratch.write(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("p")).withColumnRenamed("a", "node"), "hooks")
        # four hooks in a row, that is two pointer jumps
        step = lambda c, to: hook.select(F.col("node").alias(c), F.col("p").alias(to))
        far = hook.join(step("p", "p2"), "p").join(step("p2", "p3"), "p2").join(step("p3", "p4"), "p3")
        hook, old = scratch.write(far.select("node", F.col("p4").alias("p")), "jumps"), hook
        scratch.drop(old)
        to = lambda c: hook.select(F.col("node").alias(c), F.col("p").alias(f"{c}_p"))
        edges, old = scratch.write(edges.join(to("a"), "a").join(to("b"), "b").select(F.least("a_p", "b_p").alias("a"), F.greatest("a_p", "b_p").alias("b")).filter("a < b").distinct(), "edges"), edges
        scratch.drop(old)
        if labels is None:
            labels = hook.withColumnRenamed("p", "label")
        else:
            labels, old = scratch.write(labels.join(hook.select(F.col("node").alias("label"), "p"), "label", "left").select("node", F.coalesce("p", "label").alias("label")), "labels"), labels
            scratch.drop(old)
            scratch.drop(hook)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")) if labels is None else labels
