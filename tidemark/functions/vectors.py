"""Nearest-centre assignment of dense vectors, Arrow batch by Arrow batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F


# A task holds this many numbers of centres at a time, 32 MB.
BLOCK_NUMBERS = 4_000_000


def nearest(vector, centres: list[tuple[int, list[float]]]) -> Column:
    """struct(cluster, distance) of the closest centre; the lower cluster wins a tie.

    A vector that is NULL, of another width than the centres, or holds a NULL or NaN has no closest centre and gives
    NULLs. The centres are a model's parameters, k rows of d numbers, so they travel with the function and every row is
    assigned where it lies, against one block of centres after the other. A batch is one matrix over Arrow's memory;
    higher-order functions over arrays would be interpreted element by element.
    """
    ordered = sorted(centres)
    if len({len(c) for _, c in ordered}) > 1:
        raise ValueError("centres must have one width")
    per_block = max(1, BLOCK_NUMBERS // max(1, len(ordered[0][1]))) if ordered else 1
    values = (F.col(vector) if isinstance(vector, str) else vector).cast("array<double>")
    best = [_nearest_of(ordered[at : at + per_block])(values) for at in range(0, len(ordered), per_block)]
    if not best:
        return F.lit(None).cast("struct<cluster: bigint, distance: double>")
    first = best[0]
    for other in best[1:]:
        # Clusters ascend from block to block, so an equal distance keeps the earlier one.
        first = F.when(other["distance"] < first["distance"], other).otherwise(first)
    return first


def _nearest_of(block: list[tuple[int, list[float]]]):
    clusters = np.array([k for k, _ in block], dtype=np.int64)
    matrix = np.array([c for _, c in block], dtype=np.float64)

    @F.arrow_udf("struct<cluster: bigint, distance: double>")
    def assign(vectors: pa.Array) -> pa.Array:
        width = matrix.shape[1]
        sizes = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(sizes == width)
        points = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), width)
        whole = np.isfinite(points).all(axis=1)
        rows, points = rows[whole], points[whole]
        best = np.full(len(points), np.inf)
        chosen = np.zeros(len(points), dtype=np.int64)
        for cluster, centre in zip(clusters, matrix):
            squares = ((points - centre) ** 2).sum(axis=1)
            closer = squares < best
            best[closer], chosen[closer] = squares[closer], cluster
        found = np.isfinite(best)
        missing = np.ones(len(vectors), dtype=bool)
        missing[rows[found]] = False
        cluster, distance = np.zeros(len(vectors), dtype=np.int64), np.zeros(len(vectors))
        cluster[rows], distance[rows] = chosen, np.sqrt(best)
        return pa.StructArray.from_arrays(
            [pa.array(cluster, mask=missing), pa.array(distance, mask=missing)], names=["cluster", "distance"]
        )

    return assign
