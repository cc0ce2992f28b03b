"""Point-in-polygon through a quadtree cover: coarse cells for the inside of a zone, fine cells along its border.

Zones come as an edge table ``zone_id, x1, y1, x2, y2`` of closed rings. A point is inside a zone when a ray to the right
crosses its edges an odd number of times. Three kinds of edges matter to the points of a fine cell:

* edges near the cell are kept with it and tested point by point;
* edges beyond it that come from below its row are crossed by every ray, so their number is one bit of the cell;
* at the height where an edge beyond it begins or ends within its row, that bit turns. Two edges that meet there cancel
  out everywhere but between them, so few cells keep such turning heights.

A cell without edges and heights lies inside or outside as a whole. Four such cells are one cell of the next level, so a
zone has as many cells as its border is long, whatever its area, and edges are never listed for the cells far from them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.spatial import crosses
from tidemark.session import materialise

PLACE = ["level", "cx", "cy"]


@dataclass
class ZoneCover:
    """Per level and cell the zones there, each with its bit, turning heights and edges; cells of level 0 are finest."""

    cells: DataFrame
    cell: float
    levels: int


def zone_cover(edges: DataFrame, cell: float) -> ZoneCover:
    """Cover zones once for any number of joins, with cells of width ``cell`` along the borders."""
    cells = materialise(cover_cells(edges, cell), "zone-cells")
    zone = F.struct("zone_id", "inside", "heights", "edges")
    gathered = materialise(cells.groupBy(*PLACE).agg(F.collect_list(zone).alias("zones")), "zone-cover")
    return ZoneCover(gathered, cell, (cells.agg(F.max("level")).first()[0] or 0) + 1)


def cover_cells(edges: DataFrame, cell: float) -> DataFrame:
    """(zone_id, level, cx, cy, inside, heights, edges): the cells of every zone.

    Inside cells of all levels have ``inside`` and nothing else. In a border cell ``inside`` is the parity of the edges
    that a ray along the foot of its row meets beyond it.
    """
    rows = materialise(_edges_by_row(edges, cell), "zone-rows")
    near = rows.select(
        "zone_id", F.explode(F.sequence("first", "last")).alias("cx"), "cy",
        F.struct("x1", "y1", "x2", "y2").alias("edge"), F.lit(None).cast("double").alias("height"),
    )
    turning = _turning_heights(rows, cell).withColumn("edge", F.lit(None).cast(near.schema["edge"].dataType))
    border = materialise(
        near.unionByName(turning)
        .groupBy("zone_id", "cx", "cy")
        .agg(F.collect_list("edge").alias("edges"), F.collect_list("height").alias("heights"))
        .withColumn("level", F.lit(0)),
        "zone-border",
    )
    # Level l holds a zone's border in its cells' ancestors; their children without border are inside or outside.
    extent = border.groupBy("zone_id").agg((F.max("cx") - F.min("cx")).alias("w"), (F.max("cy") - F.min("cy")).alias("h"))
    widest = extent.agg(F.max(F.greatest("w", "h"))).first()[0] or 0
    top = int(widest + 1).bit_length() + 1
    own = border.select("zone_id", "level", "cx", "cy")
    levels = F.explode(F.sequence(F.lit(1), F.lit(top))).alias("up")
    above = own.select("zone_id", "cx", "cy", levels).select(
        "zone_id", F.col("up").alias("level"), F.expr("shiftright(cx, up)").alias("cx"), F.expr("shiftright(cy, up)").alias("cy")
    ).distinct()
    above = materialise(above, "zone-ancestors")
    child = F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x in (0, 1) for y in (0, 1)]))
    children = above.select("zone_id", (F.col("level") - 1).alias("level"), "cx", "cy", child.alias("child")).select(
        "zone_id", "level", (F.col("cx") * 2 + F.col("child.x")).alias("cx"), (F.col("cy") * 2 + F.col("child.y")).alias("cy")
    )
    whole = children.join(own.unionByName(above), ["zone_id", *PLACE], "left_anti")
    empty = {c: F.array().cast(border.schema[c].dataType) for c in ("heights", "edges")}
    cells = border.withColumn("is_border", F.lit(True)).unionByName(
        whole.withColumns(empty).withColumn("is_border", F.lit(False))
    )
    counted = _with_parity(cells, rows)
    return counted.where("is_border OR inside").drop("is_border")


def assign_zones_cover(points: DataFrame, x: str, y: str, cover: ZoneCover, output: str) -> DataFrame:
    """Every point with the id of the zone it lies in, NULL if in none, one row per zone if zones overlap.

    One join per level, on the cell and without a hint: Catalyst broadcasts small covers, AQE splits hot cells of large
    ones. A level gives at most one row per cell, so no join multiplies points. Rows need no key. A point on a left or
    lower edge belongs to the zone, one on a right or upper edge does not.
    """
    px, py = F.col(x), F.col(y)
    found = points
    for level in range(cover.levels):
        zones = cover.cells.where(F.col("level") == level).select(
            F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), F.col("zones").alias(f"_zones_{level}")
        )
        same = [F.shiftright(_cell(c, cover.cell), level) == F.col(own) for c, own in ((px, "_cx"), (py, "_cy"))]
        found = found.join(zones, same[0] & same[1], "left").drop("_cx", "_cy")

    def inside(zone: Column) -> Column:
        above = F.filter(zone["heights"], lambda t: py >= t)
        met = F.filter(zone["edges"], lambda e: crosses(px, py, e["x1"], e["y1"], e["x2"], e["y2"]))
        return (zone["inside"].cast("int") + F.size(above) + F.size(met)) % 2 == 1

    names = [f"_zones_{level}" for level in range(cover.levels)]
    none = F.array().cast(cover.cells.schema["zones"].dataType)
    zones = F.filter(F.concat(*[F.coalesce(F.col(n), none) for n in names]), inside)
    ids = F.transform(zones, lambda z: z["zone_id"])
    return found.withColumn(output, F.explode_outer(ids)).drop(*names)


def _edges_by_row(edges: DataFrame, cell: float) -> DataFrame:
    """Every edge once per row of fine cells that it touches.

    ``first`` to ``last`` are the cells near it, one more on both sides than it passes, which covers the rounding of the
    crossing point. Cells left of them are crossed by no ray that misses the edge: there only its heights count.
    ``from_below`` tells that the edge begins below the row.
    """
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    bottom, top = F.greatest(low, F.col("cy") * cell), F.least(high, (F.col("cy") + 1) * cell)

    def at(y: Column) -> Column:
        place = (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")
        return F.greatest(F.least(place, F.greatest("x1", "x2")), F.least("x1", "x2"))

    return (
        edges.where("y1 <> y2")
        .select("zone_id", "x1", "y1", "x2", "y2", F.explode(F.sequence(_cell(low, cell), _cell(high, cell))).alias("cy"))
        .withColumns(
            {
                "first": _cell(F.least(at(bottom), at(top)), cell) - 1,
                "last": _cell(F.greatest(at(bottom), at(top)), cell) + 1,
                "from_below": _cell(low, cell) < F.col("cy"),
            }
        )
    )


def _turning_heights(rows: DataFrame, cell: float) -> DataFrame:
    """(zone_id, cx, cy, height): cells left of an odd number of edges that end at ``height`` within their row.

    Sorted from the right, the ends of one height pair up, and only the cells between the two of a pair are left of an
    odd number. A ring that is not closed leaves one over, which counts up to the left side of its zone.
    """
    ends = rows.select("zone_id", "cy", "first", F.explode(F.array("y1", "y2")).alias("height"))
    ends = ends.where(_cell("height", cell) == F.col("cy"))
    order = Window.partitionBy("zone_id", "cy", "height").orderBy(F.desc("first"))
    left = rows.groupBy("zone_id").agg(F.min("first").alias("left"))
    return (
        ends.withColumns({"nth": F.row_number().over(order), "next": F.lead("first").over(order)})
        .where("nth % 2 = 1")
        .join(left, "zone_id")
        .withColumn("next", F.coalesce("next", "left"))
        .where("next < first")
        .select("zone_id", F.explode(F.expr("sequence(next, first - 1)")).alias("cx"), "cy", "height")
    )


def _with_parity(cells: DataFrame, rows: DataFrame) -> DataFrame:
    """The cells with ``inside``, the parity of the edges beyond them that come from below their row; coarse cells by
    their lowest row. One running count per row of a zone."""
    passing = rows.where("from_below").select("zone_id", F.col("cy").alias("row"), F.col("first").alias("at"), F.lit(1).alias("edge"))
    asked = cells.select(
        "*", F.expr("shiftleft(cy, level)").alias("row"), F.expr("shiftleft(cx, level)").alias("at"), F.lit(0).alias("edge")
    )
    # From the right; a cell comes before the edges that begin in it, as those are near it.
    order = Window.partitionBy("zone_id", "row").orderBy(F.desc("at"), "edge")
    beyond = F.sum("edge").over(order.rowsBetween(Window.unboundedPreceding, 0))
    both = asked.unionByName(passing, allowMissingColumns=True).withColumn("inside", beyond % 2 == 1)
    return both.where("edge = 0").drop("row", "at", "edge")


def _cell(coordinate, cell: float) -> Column:
    c = F.col(coordinate) if isinstance(coordinate, str) else coordinate
    return F.floor(c / F.lit(float(cell)))
