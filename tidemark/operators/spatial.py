"""Point-in-polygon assignment through a grid-cell equi join.

Zones come as an edge table ``zone_id, x1, y1, x2, y2``. A point is inside a zone when a ray to the right crosses its
edges an odd number of times. Each zone is cut into the grid cells of its bounding box, and a cell keeps just the edges
a ray from inside the cell can meet, so a point is compared with one cell's edges instead of all polygons.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import materialise

def crosses(x, y, x1, y1, x2, y2) -> Column:
    """Whether the ray to the right of (x, y) crosses the edge, which must not be horizontal."""
    return ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)


@dataclass
class ZoneGrid:
    """Zones cut into cells of one size: per zone and cell the edges that matter there."""

    cells: DataFrame
    cell: float


def zone_grid(edges: DataFrame, cell: float) -> ZoneGrid:
    """Cut zones once for any number of joins. A cell holds the edges of one zone that pass near it."""
    gathered = cell_edges(edges, cell).groupBy("zone_id", "cx", "cy")
    return ZoneGrid(materialise(gathered.agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges")), "zone-grid"), cell)


def cell_edges(edges: DataFrame, cell: float) -> DataFrame:
    """(zone_id, cx, cy, x1, y1, x2, y2): per grid cell of a zone the edges that matter there.

    An edge matters in the rows of cells that its y range touches, from the zone's left side to the edge itself. One
    more cell to the right covers the rounding of the crossing point. Horizontal edges are never crossed.
    """
    left = edges.groupBy("zone_id").agg(F.min(F.least("x1", "x2")).alias("left"))
    columns = F.sequence(_cell("left", cell), _cell(F.greatest("x1", "x2"), cell) + 1)
    rows = F.sequence(_cell(F.least("y1", "y2"), cell), _cell(F.greatest("y1", "y2"), cell))
    return (
        edges.where("y1 <> y2")
        .join(left, "zone_id")
        .withColumn("cx", F.explode(columns))
        .withColumn("cy", F.explode(rows))
        .drop("left")
    )


def assign_zones(points: DataFrame, x: str, y: str, grid: ZoneGrid, output: str) -> DataFrame:
    """Every point with the id of the zone it lies in, NULL if in none, one row per zone if zones overlap.

    Crossings are counted where the point's row meets the edges of its cell, so points need no key and equal points stay
    apart. The join is on the cell without a hint: Catalyst broadcasts small grids, AQE splits hot cells of large ones.
    """
    zones = grid.cells.select(
        F.col("zone_id").alias(output), F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), F.col("edges").alias("_edges")
    )
    px, py = F.col(x), F.col(y)
    hits = F.filter("_edges", lambda e: crosses(px, py, e["x1"], e["y1"], e["x2"], e["y2"]))
    same_cell = (_cell(x, grid.cell) == F.col("_cx")) & (_cell(y, grid.cell) == F.col("_cy"))
    return points.join(zones, same_cell & (F.size(hits) % 2 == 1), "left").drop("_cx", "_cy", "_edges")


def _cell(coordinate, cell: float) -> Column:
    c = F.col(coordinate) if isinstance(coordinate, str) else coordinate
    return F.floor(c / F.lit(float(cell)))
