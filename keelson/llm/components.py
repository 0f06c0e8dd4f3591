"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace


def components(edges: DataFrame, work: Workspace, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b of any type that has an order); component is the smallest node reachable.

    Each round joins edges with the least neighbour of their ends and is written
    to the workspace; the number of rounds grows with the logarithm of the longest chain.
    The largest group costs rows in proportion to its edges.  Edges with a null
    end and self-loops are ignored; without edges the result is empty.
    """
    now = work.put(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-0"
    )
    seen, step = _mark(now), 0
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = work.put(large, f"{name}-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        step += 1
        after = work.put(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), f"{name}-{step}")
        work.drop(f"{name}-large")
        work.drop(f"{name}-{step - 1}")
        now, before, seen = after, seen, _mark(after)
        if seen == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple[int, int, int]:
    """What tells whether a round changed anything."""
    mixed = F.xxhash64("u", "v")
    row = edges.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.shiftright(mixed, 24)), F.lit(0)).alias("high"),
        F.coalesce(F.sum(mixed.bitwiseAND(0xFFFFFF)), F.lit(0)).alias("low"),
    ).first()
    return row["n"], row["high"], row["low"]
