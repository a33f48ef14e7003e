"""Connected components of an undirected graph as a DataFrame loop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected_components(edges: DataFrame, save: Callable[[DataFrame], DataFrame], src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every endpoint; a component is its smallest node.

    Each round hooks every root to its smallest neighbouring root and then follows
    parents to their roots (pointer jumping, skipped where no parent has one); the edges are
    relabelled and loops dropped, so the number of rounds is logarithmic in the longest path. A round
    saves its parents and its edges; nodes meet the parents of all rounds once, at the end. ``save``
    cuts lineage (a written table or a reliable checkpoint). Null endpoints are
    ignored; self loops make a component of one. Nothing is collected but whether a table is empty.
    """
    ends = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    first = save(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    e, rounds = first.where("a <> b"), []
    while not e.isEmpty():
        # every larger endpoint takes its smallest smaller neighbour as parent: a forest without cycles
        parent = save(e.groupBy("a").agg(F.min("b").alias("p")))
        while True:
            up = parent.select(F.col("a").alias("p"), F.col("p").alias("pp"))
            if parent.join(up, "p", "left_semi").isEmpty():
                break
            parent = save(parent.join(up, "p", "left").select("a", F.coalesce("pp", "p").alias("p")))
        rounds.append(parent)
        to = lambda c: parent.select(F.col("a").alias(c), F.col("p").alias(f"{c}_root"))
        e = e.join(to("a"), "a", "left").join(to("b"), "b", "left").select(F.coalesce("a_root", "a").alias("x"), F.coalesce("b_root", "b").alias("y"))
        e = save(e.where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())
    labels = first.select("a").unionByName(first.select(F.col("b").alias("a"))).distinct().select(F.col("a").alias("node"), F.col("a").alias("component"))
    for parent in rounds:
        labels = labels.join(parent.withColumnRenamed("a", "component"), "component", "left").select("node", F.coalesce("p", "component").alias("component"))
    return save(labels)
