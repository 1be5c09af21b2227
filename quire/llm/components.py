"""Connected components of links by set-wise union-find.

Each round hooks every node to its least neighbour, halves the paths and contracts the links to roots, until none is left.
Links and maps stay in tables of the shared folder; the driver sees counts only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import Workspace


def components(work: Workspace, name: str, links: DataFrame) -> DataFrame:
    """node, root (the least node it reaches) of every node in links (a, b); links from a node to itself are ignored."""
    edges = work.table(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-edges-0")
    roots, level = None, 0
    while roots is None or edges.count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy("a").agg(F.least("a", F.min("b")).alias("parent"))
        parents = work.table(parents, f"{name}-parents-{level}")
        above = parents.select(F.col("a").alias("parent"), F.col("parent").alias("root"))
        step = work.table(parents.join(above, "parent").select(F.col("a").alias("node"), "root"), f"{name}-step-{level}")
        level += 1
        ends = [step.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")) for x in ("a", "b")]
        moved = edges.join(ends[0], "a").join(ends[1], "b").where("root_a <> root_b")
        edges = work.table(moved.select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct(), f"{name}-edges-{level}")
        roots = step if roots is None else follow(roots, step)
    return work.table(roots, f"{name}-roots")


def follow(roots: DataFrame, step: DataFrame) -> DataFrame:
    """Roots, moved on where the step has a newer root for them."""
    newer = step.select(F.col("node").alias("root"), F.col("root").alias("newer"))
    return roots.join(newer, "root", "left").select("node", F.coalesce("newer", "root").alias("root"))
