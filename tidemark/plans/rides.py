"""Taxi and bike rides: normalisation, zones, and the faster mode per route, weekday and time of day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.times import parsed_time, time_band, weekday_name, weekday_number, whole_seconds
from tidemark.operators.cover import ZoneCover, assign_zones_cover
from tidemark.operators.spatial import ZoneGrid, assign_zones
from tidemark.operators.tables import deduplicate, lookup, union_all

RIDE_COLUMNS = ["tripduration", "starttime", "start_location_id", "stoptime", "end_location_id"]

# The labels of the comparison and of an unnamed zone.
BIKE_WINS = "Citi Bike"
TAXI_WINS = "Taxi"
TIE = "No difference"
UNKNOWN_ZONE = "Unknown zone name"

ROUTE = ["start_location_id", "end_location_id", "weekday", "time_group"]


def taxi_rides(trips: DataFrame) -> DataFrame:
    """Taxi trip records in the shape of a ride; pick-up and drop-off may still be text (ISO or HTTP dates)."""
    return (
        trips.withColumnsRenamed(
            {
                "pickup_datetime": "starttime",
                "pickup_locationid": "start_location_id",
                "dropoff_datetime": "stoptime",
                "dropoff_locationid": "end_location_id",
            }
        )
        .withColumns({c: parsed_time(c) for c in ("starttime", "stoptime")})
        .withColumn("tripduration", whole_seconds("starttime", "stoptime"))
        .select(*RIDE_COLUMNS)
    )


def bike_rides(trips: DataFrame, grid: ZoneGrid | ZoneCover, key: str) -> DataFrame:
    """Bike trips with the zones of their two stations; a station outside all zones has none.

    Times may still be text, as ISO or HTTP dates. ``key`` is kept to tell trips apart.
    """
    assign = assign_zones_cover if isinstance(grid, ZoneCover) else assign_zones
    trips = trips.withColumns({c: parsed_time(c) for c in ("starttime", "stoptime")})
    start = ("start_station_longitude", "start_station_latitude")
    end = ("end_station_longitude", "end_station_latitude")
    placed = assign(trips, *start, grid, "start_location_id")
    return assign(placed, *end, grid, "end_location_id").select(key, *RIDE_COLUMNS)


def fastest_mode(rides: DataFrame, is_bike) -> DataFrame:
    """Average seconds of both modes per route, weekday and band, where both have rides, and the faster mode.

    One table with a mode flag and one aggregation, instead of an aggregate per mode and a join of the two. A ride
    within one zone, or with an unknown zone, has no route.
    """
    averages = (
        rides.where(F.col("start_location_id") != F.col("end_location_id"))
        .withColumn("weekday", weekday_number("stoptime"))
        .withColumn("time_group", time_band("stoptime"))
        .groupBy(*ROUTE)
        .agg(
            F.avg(F.when(is_bike, F.col("tripduration"))).alias("citibike_avg_seconds"),
            F.avg(F.when(~is_bike, F.col("tripduration"))).alias("taxi_avg_seconds"),
            F.count(F.when(is_bike, F.lit(1))).alias("_bikes"),
            F.count(F.when(~is_bike, F.lit(1))).alias("_taxis"),
        )
        .where("_bikes > 0 AND _taxis > 0")
        .drop("_bikes", "_taxis")
    )
    bike, taxi = F.col("citibike_avg_seconds"), F.col("taxi_avg_seconds")
    return averages.withColumn(
        "fastest", F.when(bike < taxi, BIKE_WINS).when(taxi < bike, TAXI_WINS).otherwise(TIE)
    ).orderBy(*ROUTE)


def ride_report(
    taxi_trips: DataFrame, bike_trips: DataFrame, bike_key: str, grid: ZoneGrid | ZoneCover,
    zones: DataFrame, zone_key: str, zone_name: str,
) -> DataFrame:
    """From raw trips of both modes to the named comparison, as one plan.

    Files of one run may overlap those of another, so repeated trips count once: equal records, or equal keys for bikes.
    """
    taxi_trips, bike_trips = deduplicate(taxi_trips), deduplicate(bike_trips, [bike_key])
    taxis = taxi_rides(taxi_trips).withColumn("by_bike", F.lit(False))
    bikes = bike_rides(bike_trips, grid, bike_key).drop(bike_key).withColumn("by_bike", F.lit(True))
    both = union_all(*[r.withColumn("tripduration", F.col("tripduration").cast("double")) for r in (taxis, bikes)])
    return named_routes(fastest_mode(both, F.col("by_bike")), zones, zone_key, zone_name)


SUBTOTALS = [
    ROUTE, ["start_location_id", "end_location_id", "weekday"], ["start_location_id", "end_location_id"],
    ["start_location_id"], ["end_location_id"], ["weekday", "time_group"], ["time_group"], [],
]


def ride_subtotals(rides: DataFrame, sets: list[list[str]] | None = None) -> DataFrame:
    """Rides, exact total seconds and mean seconds of many groupings at once: one Expand and one aggregation.

    ``sets`` are lists of columns of the route (start, end, weekday, band); the default holds routes, their subtotals and
    the grand total. A column that is not grouped by is NULL, and so is an unknown zone: ``grouping_id`` tells them apart.
    Its bits, from the highest, stand for start, end, weekday and band; a set bit means all values of that column.
    Expand copies a row once per set, and every copy is reduced in its task before the shuffle, the grand total too.
    """
    columns = {c: F.col(c) for c in ROUTE}
    banded = rides.withColumns({"weekday": weekday_number("stoptime"), "time_group": time_band("stoptime")}).select(
        *ROUTE, F.col("tripduration").cast("decimal(28,6)").alias("_seconds")
    )
    grouped = banded.groupingSets([[columns[c] for c in own] for own in sets or SUBTOTALS], *columns.values())
    totals = grouped.agg(
        F.grouping_id(*ROUTE).cast("long").alias("grouping_id"),
        F.count("*").alias("n_rides"),
        F.count("_seconds").alias("_timed"),
        F.sum("_seconds").cast("double").alias("total_seconds"),
    )
    mean = F.when(F.col("_timed") > 0, F.col("total_seconds") / F.col("_timed"))
    return totals.withColumn("avg_seconds", mean).drop("_timed")


def named_routes(report: DataFrame, zones: DataFrame, zone_key: str, zone_name: str) -> DataFrame:
    """The report with zone names and day names beside the numbers, in the order of the routes."""
    report = lookup(report, "start_location_id", zones, zone_key, zone_name, "start_zone", UNKNOWN_ZONE)
    report = lookup(report, "end_location_id", zones, zone_key, zone_name, "end_zone", UNKNOWN_ZONE)
    # Joins keep no order, so the sort stands after them.
    return report.withColumn("weekday_name", weekday_name("weekday")).orderBy(*ROUTE)
