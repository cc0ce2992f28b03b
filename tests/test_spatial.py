"""Point-in-polygon against plain Python, in both join forms."""

import random

import pytest

from tidemark.operators import spatial
from tidemark.plans.rides import bike_rides


def polygon_edges(zone, corners):
    return [(zone, *map(float, a), *map(float, b)) for a, b in zip(corners, corners[1:] + corners[:1])]


SQUARE = polygon_edges(1, [(0, 0), (4, 0), (4, 4), (0, 4)])
OVERLAP = polygon_edges(2, [(2, 2), (6, 2), (6, 6), (2, 6)])
STAR = polygon_edges(3, [(-5, -1), (-4, -3), (-6, -2), (-3, -2), (-5.5, -3.3)])
EDGE_SCHEMA = "zone_id int, x1 double, y1 double, x2 double, y2 double"


def inside(x, y, edges):
    """Angle-free check in plain Python: count the edges to the right."""
    hits = 0
    for _, x1, y1, x2, y2 in edges:
        if (y1 > y) != (y2 > y):
            t = (y - y1) / (y2 - y1)
            hits += x < x1 + t * (x2 - x1)
    return hits % 2 == 1


def assign(spark, points, cell):
    edges = spark.createDataFrame(SQUARE + OVERLAP + STAR, EDGE_SCHEMA)
    df = spark.createDataFrame(points, "id int, x double, y double")
    found = spatial.assign_zones(df, "x", "y", spatial.zone_grid(edges, cell), "zone")
    return sorted((r["id"], r["zone"] or 0) for r in found.collect())


def without_broadcast(spark, request):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))


def test_none_one_two_zones_and_an_edge(spark):
    points = [(1, 9.0, 9.0), (2, 1.0, 1.0), (3, 3.0, 3.0), (4, 0.0, 1.0), (5, 4.0, 1.0), (6, None, 1.0)]
    # A point on a left edge is inside, one on a right edge is not, so neighbours never share it.
    assert assign(spark, points, 1.0) == [(1, 0), (2, 1), (3, 1), (3, 2), (4, 1), (5, 0), (6, 0)]


@pytest.mark.parametrize("cell", [0.7, 3.0, 50.0])
@pytest.mark.parametrize("shuffled", [False, True])
def test_equals_brute_force(spark, cell, shuffled, request):
    if shuffled:
        without_broadcast(spark, request)
    rng = random.Random(3)
    points = [(i, rng.uniform(-7, 7), rng.uniform(-7, 7)) for i in range(400)]
    # A third of the points lie in one cell.
    points += [(400 + i, rng.uniform(2, 2.5), rng.uniform(2, 2.5)) for i in range(200)]
    expected = []
    for i, x, y in points:
        zones = [z[0][0] for z in (SQUARE, OVERLAP, STAR) if inside(x, y, z)]
        expected += [(i, z) for z in zones or [0]]
    assert assign(spark, points, cell) == sorted(expected)


def test_bike_rides_get_both_zones(spark):
    trips = spark.createDataFrame(
        [(1, 60, 1.0, 1.0, 5.0, 5.0), (2, 30, 1.0, 3.0, 9.0, 9.0)],
        "id int, tripduration int, start_station_longitude double, start_station_latitude double, "
        "end_station_longitude double, end_station_latitude double",
    ).selectExpr("*", "timestamp_ntz'2021-01-01' AS starttime", "timestamp_ntz'2021-01-01' AS stoptime")
    edges = spark.createDataFrame(SQUARE + OVERLAP, EDGE_SCHEMA)
    found = bike_rides(trips, spatial.zone_grid(edges, 2.0), "id").orderBy("id").collect()
    assert [(r["start_location_id"], r["end_location_id"]) for r in found] == [(1, 2), (1, None)]


@pytest.mark.parametrize("shuffled", [False, True])
def test_overlapping_zones_repeated_and_null_keys(spark, shuffled, request):
    if shuffled:
        without_broadcast(spark, request)
    trips = spark.createDataFrame(
        [(1, 3.0, 3.0, 1.0, 1.0), (1, 3.0, 3.0, 1.0, 1.0), (None, 1.0, 1.0, 5.0, 5.0), (None, 9.0, 9.0, 3.0, 3.0)],
        "id int, start_station_longitude double, start_station_latitude double, "
        "end_station_longitude double, end_station_latitude double",
    ).selectExpr("*", "60 AS tripduration", "'2021-01-01T00:00:00' AS starttime", "'Fri, 01 Jan 2021 00:01:00 GMT' AS stoptime")
    edges = spark.createDataFrame(SQUARE + OVERLAP, EDGE_SCHEMA)
    found = bike_rides(trips, spatial.zone_grid(edges, 2.0), "id").collect()
    pairs = sorted(((r["id"], r["start_location_id"], r["end_location_id"]) for r in found), key=str)
    both = [(1, 1, 1), (1, 1, 1), (1, 2, 1), (1, 2, 1)]
    assert pairs == sorted([*both, (None, 1, 2), (None, None, 1), (None, None, 2)], key=str)
    assert {(str(r["starttime"]), str(r["stoptime"])) for r in found} == {("2021-01-01 00:00:00", "2021-01-01 00:01:00")}
