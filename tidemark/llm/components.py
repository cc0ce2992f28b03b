"""Connected components of a graph given as edges, by alternating stars; no vertex's edges meet in one task's memory."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import materialise

# Far above the logarithm of any graph; more rounds are an error, never an unfinished result.
MAX_ROUNDS = 100


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """(u, least): the smallest of every vertex and its neighbours."""
    return edges.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is tied to the smallest neighbour."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    tied = both.join(_least_neighbour(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return tied.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every vertex and its smaller neighbours are tied to the smallest of them; edges go from larger to smaller."""
    least = _least_neighbour(edges)
    tied = edges.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return tied.unionByName(least.select("u", F.col("least").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for every vertex of an edge the smallest vertex it can reach.

    ``edges`` has two columns of one ordered type. Each round is written to the shared folder; the rounds end when the
    edges are a star around every smallest vertex, after a number of rounds that grows with the logarithm of the graph.
    """
    first, second = edges.columns
    directed = edges.select(F.greatest(first, second).alias("u"), F.least(first, second).alias("v"))
    current = materialise(directed.where("u <> v").distinct(), "edges")
    mark = None
    for _ in range(MAX_ROUNDS):
        state = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.count_distinct("u")).first()
        if tuple(state) == mark:
            break
        mark = tuple(state)
        current = materialise(_small_star(_large_star(current)), "edges")
    else:
        raise RuntimeError(f"components are not complete after {MAX_ROUNDS} rounds")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
