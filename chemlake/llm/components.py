"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chemlake.llm.workspace import Workspace


def connected_components(edges: DataFrame, workspace: Workspace, name: str = "components") -> DataFrame:
    """(node, component) of every node of edges (a, b): component is the smallest node that it reaches.

    Alternates the large-star and small-star steps until every node points at its smallest one; each round
    is written to the workspace.  Each step sends a row per edge and takes minima with map-side
    pre-aggregation; minima are written before edges meet them, so that the join deals edges of its own and Spark
    splits those of a node with very many.  Loops, repeated edges and
    an empty table are fine; edges with a null end are left out.
    """
    clean = edges.where(F.col("a") != F.col("b"))
    current = workspace.save(clean.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-0")
    state, rounds = _state(current), 0
    while state[0]:
        rounds += 1
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = workspace.save(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), f"{name}-least{rounds}")
        following = workspace.save(_small_star(_large_star(both, least)), f"{name}-{rounds}")
        workspace.drop(f"{name}-{rounds - 1}")
        workspace.drop(f"{name}-least{rounds}")
        current, before = following, state
        state = _state(current)
        if state == before:
            break
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31)))).first()
    return tuple(row)


def _large_star(both: DataFrame, least: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each smaller neighbour of a node, and the node, is tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v"))).distinct()
