"""Workloads W1 to W6 on the test tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from benchqueries import query, rounded, table
from tidemark.functions.times import MICROS, time_band, weekday_name, weekday_number, whole_seconds
from tidemark.operators.cover import assign_zones_cover, zone_cover
from tidemark.operators.spatial import ZoneGrid, assign_zones, zone_grid
from tidemark.operators.tables import lookup
from tidemark.plans import events as event_plans, listings, pageviews, ratings, rides, vectors


@query("""
SELECT CAST(ts AS DATE) AS date, user_id AS "user", count(*) AS n_events
FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL GROUP BY 1, 2
""")
def event_stats(spark, sf):
    return event_plans.event_stats(table(spark, sf, "events"), "ts", "user_id")


RATING = ("l_partkey", "l_suppkey", "l_quantity")


@query("""
SELECT l_partkey AS "movieId", round(avg(l_quantity) + 1.3e-7, 4) AS avg_rating, count(DISTINCT l_suppkey) AS num_ratings
FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 2
""")
def rank_movies(spark, sf):
    return rounded(ratings.rank_items(table(spark, sf, "lineitem"), *RATING), "avg_rating")


@query("""
SELECT l_partkey AS "movieId", round(avg(l_quantity) + 1.3e-7, 4) AS avg_rating, count(DISTINCT l_suppkey) AS num_ratings
FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY 1
ORDER BY avg(l_quantity) DESC NULLS LAST, num_ratings DESC, 1 LIMIT 5
""")
def popularity_top_n(spark, sf):
    return rounded(ratings.most_popular(table(spark, sf, "lineitem"), *RATING), "avg_rating")


CUMULATIVE = """
SELECT l_partkey AS "movieId", round(avg(l_quantity) + 1.3e-7, 4) AS avg_rating, count(*) AS num_ratings
FROM lineitem WHERE CAST(l_shipdate AS DATE) <= DATE '1998-01-01' GROUP BY 1
"""


@query(CUMULATIVE)
def cumulative_ranking(spark, sf):
    ranking = ratings.cumulative_ranking(
        table(spark, sf, "lineitem"), "l_partkey", "l_quantity", "l_shipdate", "1998-01-01"
    )
    return rounded(ranking, "avg_rating")


@query(CUMULATIVE)
def templated_sql(spark, sf):
    ranking = ratings.cumulative_ranking_sql(
        table(spark, sf, "lineitem"), "l_partkey", "l_quantity", "l_shipdate", "1998-01-01"
    )
    return rounded(ranking, "avg_rating")


@query("""
WITH hourly AS (
  SELECT event_type AS pagename, hour(ts) AS hr, avg("value") AS average FROM events
  WHERE event_type IS NOT NULL GROUP BY 1, 2
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY pagename ORDER BY average DESC NULLS LAST, hr) AS rn FROM hourly
)
SELECT pagename, CAST(hr AS INTEGER) AS "hour", round(average + 1.3e-7, 4) AS average_pageviews FROM ranked WHERE rn = 1
""")
def best_hour(spark, sf):
    return rounded(pageviews.best_hour(table(spark, sf, "events"), "event_type", "value", "ts"), "average_pageviews")


@query("""
WITH wanted AS (SELECT unnest(['src1', 'src2', 'src3', 'src7', 'absent']) AS pagename),
found AS (
  SELECT source, arg_max(n_chars, doc_id) AS n FROM documents
  WHERE lang = 'en' AND source IN ('src1', 'src2', 'src3', 'src7', 'absent') GROUP BY 1
)
SELECT pagename, CAST(coalesce(n, 0) AS BIGINT) AS pageviewcount FROM wanted LEFT JOIN found ON source = pagename
""")
def keyword_last_value(spark, sf):
    return pageviews.tracked_views(
        table(spark, sf, "documents"), ["src1", "src2", "src3", "src7", "absent"], "en", ["doc_id"],
        domain_column="lang", page_column="source", views_column="n_chars",
    )


# Ship days stand for dumps, return flags for domains, line states for pages.
DUMPS = """
WITH last_line AS (
  SELECT l_shipdate AS d, l_linestatus AS p, l_quantity AS n,
         row_number() OVER (PARTITION BY l_shipdate, l_linestatus
                            ORDER BY l_orderkey DESC, l_linenumber DESC, l_quantity DESC) AS back
  FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus IN ('O', 'F', 'absent')
), grid AS (
  SELECT d, unnest(['O', 'F', 'absent']) AS p FROM (SELECT DISTINCT l_shipdate AS d FROM lineitem)
), counts AS (
  SELECT grid.p AS pagename, coalesce(n, 0) AS pageviewcount, grid.d AS datetime
  FROM grid LEFT JOIN last_line l ON l.d = grid.d AND l.p = grid.p AND back = 1
)
"""


@query(DUMPS + "SELECT * FROM counts")
def tracked_views_backfill(spark, sf):
    return pageviews.tracked_views_per_interval(
        table(spark, sf, "lineitem"), ["O", "F", "absent"], "A", ["l_orderkey", "l_linenumber"], "l_shipdate",
        domain_column="l_returnflag", page_column="l_linestatus", views_column="l_quantity",
    )


LISTING = ("o_custkey", "o_totalprice", "o_orderdate")

# The plain form: both ends joined back, every pair listed.
PAIRS = """
WITH listing AS (
  SELECT o_custkey AS id, o_totalprice AS price, CAST(o_orderdate AS DATE) AS d FROM orders
  WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
), ends AS (
  SELECT id, min(d) AS dmin, max(d) AS dmax FROM listing GROUP BY id
), pairs AS (
  SELECT e.id, dmin, a.price AS oldest_price, dmax, b.price AS latest_price,
         (b.price - a.price) / date_diff('day', dmin, dmax) AS change
  FROM ends e LEFT JOIN listing a ON a.id = e.id AND a.d = dmin LEFT JOIN listing b ON b.id = e.id AND b.d = dmax
  WHERE dmin <> dmax
)
"""


@query(PAIRS + """
SELECT id, dmin AS download_date_min, dmax AS download_date_max, count(*) AS n_pairs,
       round(min(change) + 1.3e-7, 4) AS min_diff_per_day, round(max(change) + 1.3e-7, 4) AS max_diff_per_day,
       round(avg(change) + 1.3e-7, 4) AS avg_diff_per_day
FROM pairs GROUP BY id, dmin, dmax
""")
def price_change(spark, sf):
    return rounded(
        listings.price_change(table(spark, sf, "orders"), *LISTING),
        "min_diff_per_day", "max_diff_per_day", "avg_diff_per_day",
    )


@query("""
WITH listing AS (
  SELECT o_custkey AS id, o_totalprice AS price, CAST(o_orderdate AS DATE) AS d FROM orders
  WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
), ends AS (
  SELECT id, 'oldest' AS endpoint, min(d) AS d FROM listing GROUP BY id
  UNION ALL SELECT id, 'latest' AS endpoint, max(d) AS d FROM listing GROUP BY id
)
SELECT e.id, endpoint, e.d AS date, price, count(*) AS n_rows
FROM ends e JOIN listing l ON l.id = e.id AND l.d = e.d GROUP BY 1, 2, 3, 4
""")
def price_endpoints(spark, sf):
    return listings.price_endpoints(table(spark, sf, "orders"), *LISTING)


TOP = """
SELECT id, dmin AS download_date_min, oldest_price, dmax AS download_date_max, latest_price,
       round(change + 1.3e-7, 4) AS price_diff_per_day
FROM pairs ORDER BY change {} NULLS LAST, id, oldest_price, latest_price LIMIT 5
"""


@query(PAIRS + TOP.format("DESC"))
def price_top5_up(spark, sf):
    return rounded(listings.top_changes(table(spark, sf, "orders"), *LISTING), "price_diff_per_day")


@query(PAIRS + TOP.format("ASC"))
def price_top5_down(spark, sf):
    return rounded(listings.top_changes(table(spark, sf, "orders"), *LISTING, rising=False), "price_diff_per_day")


# Rides from events: zones from two ids, the event time as stop, the value as duration.
RIDES = """
ride AS (
  SELECT event_id, event_type IN ('click', 'view') AS is_taxi, user_id % 10 AS s, event_id % 7 AS e, ts, "value" AS dur
  FROM events
), banded AS (
  SELECT *, CASE WHEN hour(ts) BETWEEN 8 AND 10 THEN '8 AM - 11 AM' WHEN hour(ts) BETWEEN 11 AND 15 THEN '11 AM - 4 PM'
                 WHEN hour(ts) BETWEEN 16 AND 18 THEN '4 PM - 7 PM' WHEN hour(ts) BETWEEN 19 AND 21 THEN '7 PM - 10 PM'
                 ELSE '10 PM - 8 AM' END AS time_group
  FROM ride
), sided AS (
  SELECT is_taxi, s, e, CAST(dayofweek(ts) AS INTEGER) AS weekday, time_group, avg(dur) AS secs
  FROM banded WHERE s <> e GROUP BY ALL
), report AS (
  SELECT b.s AS start_location_id, b.e AS end_location_id, b.weekday, b.time_group,
         round(b.secs + 1.3e-7, 4) AS citibike_avg_seconds, round(t.secs + 1.3e-7, 4) AS taxi_avg_seconds,
         CASE WHEN b.secs < t.secs THEN 'Citi Bike' WHEN t.secs < b.secs THEN 'Taxi' ELSE 'No difference' END AS fastest
  FROM sided b JOIN sided t ON b.s = t.s AND b.e = t.e AND b.weekday = t.weekday AND b.time_group = t.time_group
  WHERE NOT b.is_taxi AND t.is_taxi
)
"""


def _rides(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_type",
        (F.col("user_id") % 10).alias("start_location_id"),
        (F.col("event_id") % 7).alias("end_location_id"),
        F.col("ts").alias("stoptime"),
        F.col("value").alias("tripduration"),
    )


def _report(spark, sf) -> DataFrame:
    return rides.fastest_mode(_rides(spark, sf), ~F.col("event_type").isin("click", "view"))


@query("WITH" + RIDES + "SELECT * FROM report")
def fastest_mode(spark, sf):
    return rounded(_report(spark, sf), "citibike_avg_seconds", "taxi_avg_seconds")


@query("WITH" + RIDES + """
SELECT report.*, coalesce(a.n_name, 'Unknown zone name') AS start_zone, coalesce(b.n_name, 'Unknown zone name') AS end_zone,
       CASE weekday WHEN 0 THEN 'Sunday' WHEN 1 THEN 'Monday' WHEN 2 THEN 'Tuesday' WHEN 3 THEN 'Wednesday'
                    WHEN 4 THEN 'Thursday' WHEN 5 THEN 'Friday' ELSE 'Saturday' END AS weekday_name
FROM report LEFT JOIN nation a ON a.n_nationkey = start_location_id LEFT JOIN nation b ON b.n_nationkey = end_location_id
""")
def fastest_mode_named(spark, sf):
    report = rounded(_report(spark, sf), "citibike_avg_seconds", "taxi_avg_seconds")
    return rides.named_routes(report, table(spark, sf, "nation"), "n_nationkey", "n_name")


@query("WITH" + RIDES + """
SELECT nullif(s, 9) AS start_location_id, e AS end_location_id, weekday, time_group,
       CAST(grouping_id(nullif(s, 9), e, weekday, time_group) AS BIGINT) AS grouping_id, count(*) AS n_rides,
       CAST(sum(CAST(dur AS DECIMAL(28,6))) AS DOUBLE) AS total_seconds,
       CAST(sum(CAST(dur AS DECIMAL(28,6))) AS DOUBLE) / count(dur) AS avg_seconds
FROM (SELECT *, CAST(dayofweek(ts) AS INTEGER) AS weekday FROM banded)
GROUP BY GROUPING SETS ((nullif(s, 9), e, weekday, time_group), (nullif(s, 9), e, weekday), (nullif(s, 9), e),
                        (nullif(s, 9)), (e), (weekday, time_group), (time_group), ())
""")
def route_rollup(spark, sf):
    """Routes with all their subtotals; rides from zone 9 stand for those from an unknown zone."""
    known = F.when(F.col("start_location_id") != 9, F.col("start_location_id"))
    return rides.ride_subtotals(_rides(spark, sf).withColumn("start_location_id", known))


@query("""
SELECT event_id, CAST(hour(ts) AS INTEGER) AS "hour",
       CASE WHEN hour(ts) BETWEEN 8 AND 10 THEN '8 AM - 11 AM' WHEN hour(ts) BETWEEN 11 AND 15 THEN '11 AM - 4 PM'
            WHEN hour(ts) BETWEEN 16 AND 18 THEN '4 PM - 7 PM' WHEN hour(ts) BETWEEN 19 AND 21 THEN '7 PM - 10 PM'
            ELSE '10 PM - 8 AM' END AS time_group
FROM events
""")
def time_band_of_event(spark, sf):
    return table(spark, sf, "events").select("event_id", F.hour("ts").alias("hour"), time_band("ts").alias("time_group"))


@query("SELECT event_id, CAST(dayofweek(ts) AS INTEGER) AS weekday, dayname(ts) AS weekday_name FROM events")
def weekday_of_event(spark, sf):
    number = weekday_number("ts")
    return table(spark, sf, "events").select(
        "event_id", number.alias("weekday"), weekday_name(number).alias("weekday_name")
    )


@query("""
SELECT event_id, user_id, coalesce(n_name, 'Unknown zone name') AS zone_name
FROM events LEFT JOIN nation ON n_nationkey = user_id
""")
def lookup_default(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id")
    nations = table(spark, sf, "nation")
    return lookup(events, "user_id", nations, "n_nationkey", "n_name", "zone_name", rides.UNKNOWN_ZONE)


# Each nation is a diamond on a 5 x 5 grid of unit squares; gaps between diamonds belong to no zone.
ZONES = """
centre AS (
  SELECT n_nationkey AS zone_id, CAST(n_nationkey % 5 AS DOUBLE) AS cx, CAST(n_nationkey // 5 AS DOUBLE) AS cy FROM nation
), corner AS (
  SELECT zone_id, cx - 0.5 AS ax, cy AS ay, cx AS bx, cy + 0.5 AS byy FROM centre
  UNION ALL SELECT zone_id, cx, cy + 0.5, cx + 0.5, cy FROM centre
  UNION ALL SELECT zone_id, cx + 0.5, cy, cx, cy - 0.5 FROM centre
  UNION ALL SELECT zone_id, cx, cy - 0.5, cx - 0.5, cy FROM centre
), trip AS (
  SELECT event_id, ts, "value" AS dur,
         (user_id * 37 % 500) / 100.0 - 0.47 AS sx, (event_id * 13 % 500) / 100.0 - 0.47 AS sy,
         (user_id * 91 % 700) / 100.0 - 0.47 AS ex, (event_id * 7 % 500) / 100.0 - 0.47 AS ey
  FROM events
), start_zone AS (
  SELECT event_id, zone_id FROM trip JOIN corner
    ON (ay > sy) <> (byy > sy) AND sx < (bx - ax) * (sy - ay) / (byy - ay) + ax
  GROUP BY 1, 2 HAVING count(*) % 2 = 1
), end_zone AS (
  SELECT event_id, zone_id FROM trip JOIN corner
    ON (ay > ey) <> (byy > ey) AND ex < (bx - ax) * (ey - ay) / (byy - ay) + ax
  GROUP BY 1, 2 HAVING count(*) % 2 = 1
)
"""


def _zone_edges(spark, sf) -> DataFrame:
    n = F.col("n_nationkey")
    cx, cy = (n % 5).cast("double"), F.floor(n / 5).cast("double")
    corners = [(cx - 0.5, cy), (cx, cy + 0.5), (cx + 0.5, cy), (cx, cy - 0.5)]
    edges = [
        F.struct(a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2"))
        for a, b in zip(corners, corners[1:] + corners[:1])
    ]
    nations = table(spark, sf, "nation")
    return nations.select(n.alias("zone_id"), F.explode(F.array(*edges)).alias("e")).select("zone_id", "e.*")


def _zone_grid(spark, sf) -> ZoneGrid:
    return zone_grid(_zone_edges(spark, sf), 1.0)


def _bike_trips(spark, sf) -> DataFrame:
    def place(column: str, step: int, span: int):
        return (F.col(column) * step % span).cast("double") / 100.0 - 0.47

    return table(spark, sf, "events").select(
        "event_id",
        F.col("value").alias("tripduration"),
        F.col("ts").alias("starttime"),
        F.col("ts").alias("stoptime"),
        place("user_id", 37, 500).alias("start_station_longitude"),
        place("event_id", 13, 500).alias("start_station_latitude"),
        place("user_id", 91, 700).alias("end_station_longitude"),
        place("event_id", 7, 500).alias("end_station_latitude"),
    )


def _start_points(spark, sf) -> DataFrame:
    return _bike_trips(spark, sf).select(
        "event_id", F.col("start_station_longitude").alias("x"), F.col("start_station_latitude").alias("y")
    )


STARTS = "WITH" + ZONES + """
SELECT trip.event_id, sx AS x, sy AS y, zone_id FROM trip LEFT JOIN start_zone USING (event_id)
"""


@query(STARTS)
def zone_assign(spark, sf):
    return assign_zones(_start_points(spark, sf), "x", "y", _zone_grid(spark, sf), "zone_id")


@query(STARTS)
def zone_assign_cover(spark, sf):
    """The same through a quadtree cover, whose fine cells are a sixteenth of a zone wide."""
    cover = zone_cover(_zone_edges(spark, sf), 0.0625)
    return assign_zones_cover(_start_points(spark, sf), "x", "y", cover, "zone_id")


@query("WITH" + ZONES + """
SELECT trip.event_id, dur AS tripduration, ts AS starttime, s.zone_id AS start_location_id, ts AS stoptime,
       e.zone_id AS end_location_id
FROM trip LEFT JOIN start_zone s USING (event_id) LEFT JOIN end_zone e USING (event_id)
""")
def bike_transform(spark, sf):
    return rides.bike_rides(_bike_trips(spark, sf), _zone_grid(spark, sf), "event_id")


def _taxi_trips(spark, sf) -> DataFrame:
    late = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.round((F.col("value") - 20) * MICROS).cast("bigint"))
    return table(spark, sf, "events").select(
        "event_id",
        F.col("ts").alias("pickup_datetime"),
        late.cast("timestamp_ntz").alias("dropoff_datetime"),
        F.col("user_id").alias("pickup_locationid"),
        (F.col("event_id") % 100).alias("dropoff_locationid"),
        F.col("value").alias("trip_distance"),
    )


TAXI = """
WITH trip AS (
  SELECT event_id, ts AS a, make_timestamp(epoch_us(ts) + CAST(round(("value" - 20) * 1000000) AS BIGINT)) AS b,
         user_id AS s, event_id % 100 AS e
  FROM events
)
"""


@query(TAXI + """
SELECT CAST(trunc((epoch_us(b) - epoch_us(a)) / 1000000.0) AS BIGINT) AS tripduration, a AS starttime,
       s AS start_location_id, b AS stoptime, e AS end_location_id
FROM trip
""")
def taxi_transform(spark, sf):
    trips = _taxi_trips(spark, sf).drop("event_id")
    text = {c: F.col(c).cast("string") for c in ("pickup_datetime", "dropoff_datetime")}
    return rides.taxi_rides(trips.withColumns(text))


@query(TAXI + """
SELECT event_id, CAST(trunc((epoch_us(b) - epoch_us(a)) / 1000000.0) AS BIGINT) AS seconds FROM trip
""")
def trip_duration(spark, sf):
    return _taxi_trips(spark, sf).select(
        "event_id", whole_seconds("pickup_datetime", "dropoff_datetime").alias("seconds")
    )


@query("WITH" + ZONES + """, taxi AS (
  SELECT user_id % 25 AS s, event_id % 25 AS e, CAST(trunc(CAST(round(("value" - 20) * 1000000) AS BIGINT) / 1000000.0) AS DOUBLE) AS dur,
         make_timestamp(epoch_us(ts) + CAST(round(("value" - 20) * 1000000) AS BIGINT)) AS b
  FROM events
), ride AS (
  SELECT true AS bike, s.zone_id AS s, e.zone_id AS e, dur, ts AS b
  FROM trip JOIN start_zone s USING (event_id) JOIN end_zone e USING (event_id)
  UNION ALL SELECT false, s, e, dur, b FROM taxi
), sided AS (
  SELECT bike, s, e, CAST(dayofweek(b) AS INTEGER) AS weekday,
         CASE WHEN hour(b) BETWEEN 8 AND 10 THEN '8 AM - 11 AM' WHEN hour(b) BETWEEN 11 AND 15 THEN '11 AM - 4 PM'
              WHEN hour(b) BETWEEN 16 AND 18 THEN '4 PM - 7 PM' WHEN hour(b) BETWEEN 19 AND 21 THEN '7 PM - 10 PM'
              ELSE '10 PM - 8 AM' END AS time_group, avg(dur) AS secs
  FROM ride WHERE s <> e GROUP BY ALL
)
SELECT CAST(x.s AS BIGINT) AS start_location_id, CAST(x.e AS BIGINT) AS end_location_id, x.weekday, x.time_group,
       round(x.secs + 1.3e-7, 4) AS citibike_avg_seconds, round(y.secs + 1.3e-7, 4) AS taxi_avg_seconds,
       CASE WHEN x.secs < y.secs THEN 'Citi Bike' WHEN y.secs < x.secs THEN 'Taxi' ELSE 'No difference' END AS fastest,
       coalesce(a.n_name, 'Unknown zone name') AS start_zone, coalesce(b.n_name, 'Unknown zone name') AS end_zone,
       CASE x.weekday WHEN 0 THEN 'Sunday' WHEN 1 THEN 'Monday' WHEN 2 THEN 'Tuesday' WHEN 3 THEN 'Wednesday'
                      WHEN 4 THEN 'Thursday' WHEN 5 THEN 'Friday' ELSE 'Saturday' END AS weekday_name
FROM sided x JOIN sided y ON x.s = y.s AND x.e = y.e AND x.weekday = y.weekday AND x.time_group = y.time_group
LEFT JOIN nation a ON a.n_nationkey = x.s LEFT JOIN nation b ON b.n_nationkey = x.e
WHERE x.bike AND NOT y.bike
""")
def ride_report(spark, sf):
    taxis = _taxi_trips(spark, sf).withColumns(
        {"pickup_locationid": F.col("pickup_locationid") % 25, "dropoff_locationid": F.col("dropoff_locationid") % 25}
    )
    bikes = _bike_trips(spark, sf)
    # Two runs delivered the first ten days: repeated trips count once.
    taxis = taxis.unionByName(taxis.where("pickup_datetime < timestamp_ntz'2024-01-11'"))
    bikes = bikes.unionByName(bikes.where("starttime < timestamp_ntz'2024-01-11'"))
    report = rides.ride_report(
        taxis, bikes, "event_id", _zone_grid(spark, sf),
        table(spark, sf, "nation"), "n_nationkey", "n_name",
    )
    return rounded(report, "citibike_avg_seconds", "taxi_avg_seconds")


CENTRES = """
WITH dims AS (
  SELECT vec_id, label, generate_subscripts(embedding, 1) AS d, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings
), centre AS (
  SELECT label AS k, d, avg(x) AS c FROM dims WHERE label IS NOT NULL GROUP BY 1, 2
), dist AS (
  SELECT vec_id, k, sqrt(sum((x - c) * (x - c))) AS distance FROM dims JOIN centre USING (d) GROUP BY 1, 2
)
SELECT vec_id, CAST(arg_min(k, distance) AS BIGINT) AS cluster, round(min(distance) + 1.3e-7, 4) AS distance FROM dist GROUP BY 1
"""


@query(CENTRES)
def nearest_centroid(spark, sf):
    embeddings = table(spark, sf, "embeddings")
    centres = vectors.mean_per_label(embeddings, "embedding", "label")
    assigned = vectors.assign_nearest(embeddings, "embedding", centres)
    return rounded(assigned.select("vec_id", "cluster", "distance"), "distance")


@query()
def kmeans_clusters(spark, sf):
    embeddings = table(spark, sf, "embeddings")
    model = vectors.train_clusters(embeddings, "embedding")
    return vectors.assign_trained(model, embeddings, "embedding").select("vec_id", "label", "cluster")


@query("SELECT vec_id, true AS is_nearest, true AS better_than_one_centre FROM embeddings")
def kmeans_properties(spark, sf):
    """What must hold for any clustering: rows lie in the nearest cluster, and ten centres cost no more than one."""
    embeddings = table(spark, sf, "embeddings")
    model = vectors.train_clusters(embeddings, "embedding")
    centres = [(k, c.tolist()) for k, c in enumerate(model.clusterCenters())]
    assigned = vectors.assign_trained(model, embeddings, "embedding").withColumnRenamed("cluster", "trained")
    found = vectors.assign_nearest(assigned, "embedding", centres)
    together = vectors.mean_per_label(embeddings.withColumn("all", F.lit(0)), "embedding", "all")
    one = vectors.assign_nearest(embeddings, "embedding", together).agg(F.sum(F.col("distance") ** 2)).scalar()
    own = found.withColumn("own", vectors.distance_to("embedding", centres, "trained"))
    return own.select(
        "vec_id",
        (F.abs(F.col("own") - F.col("distance")) < 1e-6).alias("is_nearest"),
        (F.lit(model.summary.trainingCost) <= one).alias("better_than_one_centre"),
    )


@query("""
SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS n_dims,
       round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) + 1.3e-7, 4) AS total
FROM embeddings
""")
def vector_prepare(spark, sf):
    prepared = vectors.prepare(table(spark, sf, "embeddings"), "embedding")
    values = vector_to_array("features")
    totals = prepared.select(
        "vec_id",
        "label",
        F.size(values).alias("n_dims"),
        F.aggregate(values, F.lit(0.0), lambda total, x: total + x).alias("total"),
    )
    return rounded(totals, "total")
