"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galepost.session import stage

# Every round halves the longest path at least, so this is never reached by a finite table.
MAX_ROUNDS = 64


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
    )


def connected_components(edges: DataFrame, label: str) -> DataFrame:
    """``(node, component)`` of every node of ``edges(a, b)``; a component's name is its
    least node. Each round is written to the shared folder, so lineage stays short."""
    now = stage(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        f"{label}-edges",
    )
    before = _state(now)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # Large star: greater neighbours of a node go to its least neighbour.
        large = (
            both.where("b > a")
            .join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        # Small star: a node and its smaller neighbours go to the least of these.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stage(
            moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct(),
            f"{label}-round",
        )
        after = _state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
