"""Connected components of a link table, by hooking, pointer jumping and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _flattened(parent: DataFrame, name: str) -> DataFrame:
    """Every node's parent replaced by its parent's parent until nothing moves: the depth of
    the trees halves each time."""
    while True:
        up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("root"))
        step = parent.join(up, "parent", "left").select(
            "node", F.coalesce("root", "parent").alias("parent"),
            (F.col("root").isNotNull() & (F.col("root") != F.col("parent"))).alias("moved"))
        step = stored(step, name)
        parent = step.select("node", "parent")
        if step.where("moved").isEmpty():
            return parent


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``(node, label)`` for every node of the links ``(a, b)``; the label is the smallest node
    of the component.  Nodes may be of any orderable type; repeated links and loops are fine.

    Each round hooks every node to its smallest neighbour, flattens the trees and contracts
    the links to those between trees.  Only emptiness tests come to the driver.
    """
    a, b = F.least("a", "b"), F.greatest("a", "b")
    rest = stored(links.where("a != b").select(a.alias("a"), b.alias("b")).distinct(), f"{name}-links")
    labels = None
    while not rest.isEmpty():
        hooked = _both_ways(rest).groupBy("a").agg(F.min("b").alias("low")).select(
            F.col("a").alias("node"), F.least("a", "low").alias("parent"))
        parent = _flattened(stored(hooked, f"{name}-hook"), f"{name}-jump")
        if labels is None:
            labels = parent.withColumnRenamed("parent", "label")
        else:
            up = parent.select(F.col("node").alias("label"), F.col("parent").alias("higher"))
            labels = stored(labels.join(up, "label", "left").select(
                "node", F.coalesce("higher", "label").alias("label")), f"{name}-labels")
        left = parent.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        right = parent.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        moved = rest.join(left, "a").join(right, "b").where("pa != pb")
        rest = stored(moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(),
                      f"{name}-rest")
    if labels is None:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels


def extended(labels: DataFrame, links: DataFrame, name: str = "components") -> DataFrame:
    """``labels`` after more ``links (a, b)``: only the links between different components are
    solved, as links between their labels."""
    left = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    right = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    named = stored(links.join(left, "a", "left").join(right, "b", "left").select(
        "a", "b", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb")), f"{name}-new")
    if named.isEmpty():
        return labels
    merged = components(named.select(F.col("la").alias("a"), F.col("lb").alias("b")), name)
    ends = named.select(F.col("a").alias("node"), F.col("la").alias("label")).unionByName(
        named.select(F.col("b").alias("node"), F.col("lb").alias("label")))
    every = labels.unionByName(ends).distinct()
    up = merged.select(F.col("node").alias("label"), F.col("label").alias("higher"))
    return stored(every.join(up, "label", "left").select("node", F.coalesce("higher", "label").alias("label")),
                  f"{name}-extended")
