"""Quadtree cover of zones: the same answers as edge tests, with cells in proportion to the border."""

import math
import random

import pytest

from test_spatial import EDGE_SCHEMA, OVERLAP, SQUARE, STAR, inside, polygon_edges, without_broadcast
from tidemark.operators import cover

# Horizontal and vertical sides, a notch, a hole and two rings that touch, all on and off the grid lines.
NOTCHED = polygon_edges(4, [(-7, 1), (-1, 1), (-1, 5), (-3, 5), (-3, 2.5), (-5, 2.5), (-5, 5), (-7, 5)])
HOLE = polygon_edges(5, [(1, -6), (7, -6), (7, -1), (1, -1)]) + polygon_edges(5, [(2, -5), (2, -2), (6, -2), (6, -5)])
SAW = polygon_edges(6, [(-7, -7), *[(-7 + i / 4, -6.5 if i % 2 else -6.75) for i in range(1, 40)], (3, -7)])
ZONES = [SQUARE, OVERLAP, STAR, NOTCHED, HOLE, SAW]


def found(spark, points, cell, zones=ZONES):
    edges = spark.createDataFrame([e for z in zones for e in z], EDGE_SCHEMA)
    df = spark.createDataFrame(points, "id int, x double, y double")
    rows = cover.assign_zones_cover(df, "x", "y", cover.zone_cover(edges, cell), "zone").collect()
    return sorted((r["id"], r["zone"] or 0) for r in rows)


def expected(points, zones=ZONES):
    out = []
    for i, x, y in points:
        held = [z[0][0] for z in zones if x is not None and y is not None and inside(x, y, z)]
        out += [(i, z) for z in held or [0]]
    return sorted(out)


def sample(rng, n):
    points = [(i, rng.uniform(-8, 8), rng.uniform(-8, 8)) for i in range(n)]
    # Points on grid lines, edges and corners.
    points += [(n + i, rng.randint(-32, 32) / 4, rng.randint(-32, 32) / 4) for i in range(n)]
    return points + [(2 * n, None, 1.0), (2 * n + 1, 1.0, None)]


@pytest.mark.parametrize("cell", [0.25, 0.37, 1.0, 3.0, 50.0])
def test_equals_brute_force(spark, cell):
    points = sample(random.Random(int(cell * 100)), 400)
    assert found(spark, points, cell) == expected(points)


def test_shuffled_joins_with_a_hot_cell_and_repeated_points(spark, request):
    without_broadcast(spark, request)
    rng = random.Random(4)
    points = sample(rng, 100) + [(7, rng.uniform(2, 2.2), rng.uniform(2, 2.2)) for _ in range(150)]
    points += [(8, 3.0, 3.0)] * 3
    assert found(spark, points, 0.5) == expected(points)


def test_no_zones_and_no_points(spark):
    assert found(spark, [(1, 0.0, 0.0)], 1.0, []) == [(1, 0)]
    edges = spark.createDataFrame(SQUARE, EDGE_SCHEMA)
    none = spark.createDataFrame([], "id int, x double, y double")
    assert cover.assign_zones_cover(none, "x", "y", cover.zone_cover(edges, 1.0), "zone").collect() == []


def circle(radius, corners=64):
    turn = [2 * math.pi * i / corners for i in range(corners)]
    return polygon_edges(1, [(radius * math.cos(a), radius * math.sin(a)) for a in turn])


def test_cells_grow_with_the_border_not_with_the_area(spark):
    counts = []
    for radius in (8, 32, 128):
        cells = cover.cover_cells(spark.createDataFrame(circle(radius), EDGE_SCHEMA), 1.0)
        counts.append(cells.groupBy("level").count().orderBy("level").collect())
    totals = [sum(r["count"] for r in c) for c in counts]
    assert totals[1] < 5 * totals[0] and totals[2] < 5 * totals[1]
    assert totals[2] < 0.2 * math.pi * 128**2
    # The inside is held by coarse cells: the largest circle needs levels that the smallest one has not.
    assert len(counts[2]) > len(counts[0])


def test_inside_cells_hold_no_edges(spark):
    rows = cover.cover_cells(spark.createDataFrame(circle(20), EDGE_SCHEMA), 0.5).collect()
    coarse = [r for r in rows if r["level"] > 0]
    assert coarse and all(r["inside"] and not r["edges"] and not r["heights"] for r in coarse)
    area = sum(0.25 * 4 ** r["level"] for r in rows if not r["edges"] and not r["heights"])
    assert 0.8 * math.pi * 400 < area < math.pi * 400
