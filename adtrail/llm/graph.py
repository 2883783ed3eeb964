"""Connected components of a link table, by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.llm.store import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def _to_least(edges: DataFrame, folder: str) -> DataFrame:
    """(u, v, least): each (a, b) as (u, v), with the least of u and its v's. The minima are written first, so that the
    join meets two shuffles: a node with very many links is then split over tasks."""
    least = written(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least")), folder)
    return edges.join(least, "u")


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the least node of the component.

    Links with null ends are left out. Each step is written to ``folder``; rows are never gathered by component.
    """
    now = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{folder}/links"
    )
    state, step = _state(now), 0
    while True:
        step += 1
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _to_least(both, f"{folder}/{step}-large-least").where("v > u and v <> least").select(F.col("v").alias("a"), F.col("least").alias("b")).distinct()
        large = written(large, f"{folder}/{step}-large")
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        near = _to_least(down, f"{folder}/{step}-small-least")
        small = near.where("v <> least").select(F.col("v").alias("a"), F.col("least").alias("b")).union(near.select(F.col("u").alias("a"), F.col("least").alias("b"))).distinct()
        now = written(small, f"{folder}/{step}-small")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b"), F.col("b"))).distinct()
