"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.llm.common import forget, written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours its smallest neighbour (or itself)."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours all point to the smallest of them. Rows have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v) to (node, component), component the smallest node reachable; runs jobs.

    Each round halves the height of every tree at least, so rounds grow with the
    logarithm of the longest chain. Nodes without links are not returned. Minima are
    combined before the shuffle, so a node with very many links costs a row per task.
    """
    ends = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = written(ends, "links")
    state = _state(edges)
    while state[0]:
        new = written(_small(_large(edges)), "links")
        forget(edges)
        edges, old, state = new, state, _state(new)
        if state == old:
            break
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.union(roots)
