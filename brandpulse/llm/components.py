"""Connected components of an edge table, as joins: hooking to the least neighbour, pointer jumping, contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brandpulse.llm.common import scratch


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """``(node, comp)`` for every node of ``edges (a, b)``: the least node that can be reached.

    A round hooks every root to its least neighbouring root; of two that hook each other the smaller stays a
    root, and it is the least of its tree. Trees are flattened by pointer jumping, then edges are mapped to
    their roots, without loops and doubles. Every root with an edge joins another, so roots at least halve in a
    round and there is no bound on rounds to reach. Every step is written to the shared scratch folder. A node with
    very many links is pre-aggregated in the minimum, and its partitions of the plain equi-joins can be split.
    """
    both = scratch(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), f"{name}-edges")
    levels = []
    while not both.isEmpty():
        near = scratch(both.groupBy("a").agg(F.min("b").alias("near")), f"{name}-near")
        back = near.select(F.col("a").alias("near"), F.col("near").alias("back"))
        stays = (F.col("back") == F.col("a")) & (F.col("a") < F.col("near"))
        hooked = near.join(back, "near").select(F.col("a").alias("node"), F.when(stays, F.col("a")).otherwise(F.col("near")).alias("comp"))
        up = _flat(scratch(hooked, f"{name}-hooked"), name)
        levels.append(up)
        a, b = (up.select(F.col("node").alias(c), F.col("comp").alias(f"c{c}")) for c in "ab")
        both = scratch(both.join(a, "a").join(b, "b").where("ca <> cb")
                       .select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), f"{name}-edges")
    comps = levels.pop() if levels else both.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    for up in reversed(levels):
        over = comps.select(F.col("node").alias("comp"), F.col("comp").alias("over"))
        comps = scratch(up.join(over, "comp", "left").select("node", F.coalesce("over", "comp").alias("comp")), f"{name}-labels")
    return comps


def _flat(up: DataFrame, name: str) -> DataFrame:
    """Trees ``(node, comp: parent, its own for a root)`` to ``(node, comp: root)``; every jump halves the depth."""
    while True:
        over = up.select(F.col("node").alias("comp"), F.col("comp").alias("over"))
        after = scratch(up.join(over, "comp").select("node", F.col("comp").alias("old"), F.col("over").alias("comp")), f"{name}-jumped")
        up = after.select("node", "comp")
        if after.where("old <> comp").isEmpty():
            return up


def merged_components(comps: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """``comps (node, comp)`` after further ``links (a, b)``: only the components that a link touches are solved anew."""
    ends = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    alone = ends.join(comps, "node", "left_anti").select("node", F.col("node").alias("comp"))
    known = scratch(comps.unionByName(alone), f"{name}-known")
    a, b = (known.select(F.col("node").alias(c), F.col("comp").alias(f"c{c}")) for c in "ab")
    between = links.join(a, "a").join(b, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct()
    solved = connected_components(between, name).select(F.col("node").alias("comp"), F.col("comp").alias("least"))
    return scratch(known.join(solved, "comp", "left").select("node", F.coalesce("least", "comp").alias("comp")), f"{name}-merged")
