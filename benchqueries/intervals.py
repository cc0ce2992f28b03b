"""Filters, time functions, interval operators, ordering and text operators on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from benchqueries import ltz, query, rounded, table
from tidemark.functions import text, times
from tidemark.operators import directory, distinct, filters, intervals, numbering
from tidemark.operators.tables import cutover, deduplicate, union_all
from tidemark.plans import events as event_plans
from tidemark.session import fresh_dir, materialise


@query("SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-08'")
def range_half_open(spark, sf):
    return filters.in_interval(table(spark, sf, "events"), "ts", "2024-01-05", "2024-01-08")


@query("SELECT * FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-01-31'")
def range_closed(spark, sf):
    return filters.between(table(spark, sf, "orders"), "o_orderdate", "1997-01-01", "1997-01-31")


EPOCH = """
WITH rated AS (
  SELECT l_orderkey, l_linenumber, CAST(floor(epoch(l_shipdate)) AS BIGINT) AS seconds FROM lineitem
)
"""


def _epochs(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.unix_seconds(ltz("l_shipdate")).alias("seconds")
    )


@query(EPOCH + """
SELECT l_orderkey, l_linenumber, seconds, make_timestamp(seconds * 1000000) AS ts FROM rated
WHERE seconds >= 852076800 AND seconds < 854755200
""")
def epoch_range(spark, sf):
    chosen = filters.in_epoch_interval(_epochs(spark, sf), "seconds", "1997-01-01", "1997-02-01")
    return chosen.withColumn("ts", F.timestamp_seconds("seconds").cast("timestamp_ntz"))


@query(EPOCH + "SELECT l_orderkey, l_linenumber, seconds, CAST(make_timestamp(seconds * 1000000) AS DATE) AS date FROM rated")
def epoch_to_date(spark, sf):
    return _epochs(spark, sf).withColumn("date", times.epoch_date("seconds"))


@query("SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1997-12-01' AND o_orderdate < TIMESTAMP '1998-01-01'")
def month_window(spark, sf):
    return filters.in_month(table(spark, sf, "orders"), "o_orderdate", 1997, 12)


@query("""
SELECT * FROM events WHERE ts <= (SELECT max(ts) FROM events)
AND ts >= (SELECT max(ts) FROM events) - INTERVAL 15 MINUTE
""")
def trailing_window(spark, sf):
    return filters.trailing(table(spark, sf, "events"), "ts", 15, "minute")


@query("SELECT * FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 59 MINUTE")
def retention_filter(spark, sf):
    return filters.retain(table(spark, sf, "events"), "ts")


@query("SELECT o_orderkey, o_orderdate, o_orderdate + INTERVAL 5 YEAR AS shifted FROM orders")
def year_shift(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", times.shift_years("o_orderdate", 5).alias("shifted")
    )


QUARTERS = "SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS interval_start, count(*) AS n_events FROM events GROUP BY 1"


@query(QUARTERS)
def quarter_hour_counts(spark, sf):
    return (
        table(spark, sf, "events")
        .groupBy(times.quarter_hour("ts").alias("interval_start"))
        .agg(F.count("*").alias("n_events"))
    )


@query("""
SELECT event_id, strftime(ts, '%Y/%Y-%m/pageviews-%Y%m%d-%H0000.gz') AS hourly_path,
       strftime(ts, 'ratings/%Y/%m.csv') AS monthly_path, strftime(ts, '%Y%m%dT%H%M%S') AS run_key
FROM events
""")
def interval_paths(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        text.hourly_dump_path("ts").alias("hourly_path"),
        text.monthly_path("ts", "ratings").alias("monthly_path"),
        times.compact_key("ts").alias("run_key"),
    )


@query("""
SELECT event_id, ts, user_id, (SELECT count(*) FROM events) AS total FROM events
ORDER BY ts, user_id, event_id LIMIT 100 OFFSET 200
""")
def page_slice(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "user_id")
    return numbering.page(events, ["ts", "user_id", "event_id"], 200, 100)


@query("""
SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity, (SELECT count(*) FROM lineitem) AS total FROM lineitem
ORDER BY l_shipdate, l_orderkey, l_linenumber LIMIT 500 OFFSET 4321
""")
def page_directory_slice(spark, sf):
    """A page far past the first thousand rows, through a directory of sorted chunks."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    return directory.page_directory(lines, ["l_shipdate", "l_orderkey", "l_linenumber"]).page(4321, 500)


@query("""
WITH per_day AS (SELECT DISTINCT CAST(ts AS DATE) AS last FROM events WHERE ts IS NOT NULL)
SELECT last AS "range", event_type, count(DISTINCT user_id) AS n_users
FROM per_day JOIN events ON CAST(ts AS DATE) BETWEEN last - 6 AND last WHERE user_id IS NOT NULL GROUP BY 1, 2
""")
def distinct_by_bitmap(spark, sf):
    """Distinct users of each event type in the seven days up to every day, from bitmaps per day."""
    events = table(spark, sf, "events")
    numbers = distinct.user_numbers(events, "user_id")
    bitmaps = distinct.day_bitmaps(events, ["event_type"], "ts", "user_id", numbers)
    return distinct.distinct_in_ranges(bitmaps, ["event_type"], distinct.trailing_ranges(events, "ts", 7))


@query("""
WITH per_day AS (SELECT DISTINCT CAST(ts AS DATE) AS last FROM events WHERE ts IS NOT NULL)
SELECT last AS "range", event_type, count(*) AS n_rows, count(DISTINCT event_id) AS exact_users,
       true AS users_within, true AS quartiles_within
FROM per_day JOIN events ON CAST(ts AS DATE) BETWEEN last - 6 AND last GROUP BY 1, 2
""")
def distinct_by_sketch(spark, sf):
    """Distinct events and quartiles of their values in the seven days up to every day, from sketches per day.

    Beside them the exact figures from the rows, and whether the estimates keep to the stated bounds: four standard
    errors for the count, and the rank error on either side of each quartile.
    """
    events, quartiles = table(spark, sf, "events"), [0.25, 0.5, 0.75]
    ranges = materialise(distinct.trailing_ranges(events, "ts", 7), "trailing-ranges")
    sketches = distinct.day_sketches(events, ["event_type"], "ts", "event_id", "value")
    merged = materialise(distinct.sketches_in_ranges(sketches, ["event_type"], ranges, quartiles), "merged-sketches")
    users = distinct.exact_in_ranges(events, ["event_type"], "ts", "event_id", ranges)
    sought = distinct.days_of(ranges).join(merged.select("range", "event_type", "values_at"), "range")
    held = events.select("event_type", "value", F.col("ts").cast("date").alias("day")).join(sought, ["day", "event_type"])
    at = [F.col("values_at")[i] for i in range(len(quartiles))]
    ranked = held.groupBy("range", "event_type").agg(
        F.array(*[F.avg((F.col("value") < v).cast("double")) for v in at]).alias("below"),
        F.array(*[F.avg((F.col("value") <= v).cast("double")) for v in at]).alias("up_to"),
    )
    exact = ranked.join(users.withColumnRenamed("n_users", "exact_users"), ["range", "event_type"], "left")
    exact = exact.withColumn("exact_users", F.coalesce("exact_users", F.lit(0).cast("long")))
    slack = 2 * distinct.KLL_RANK_ERROR
    ranks = [(F.col("below")[i] <= q + slack) & (F.col("up_to")[i] >= q - slack) for i, q in enumerate(quartiles)]
    error = F.abs(F.col("n_users") - F.col("exact_users"))
    return merged.join(exact, ["range", "event_type"]).select(
        "range", "event_type", "n_rows", "exact_users",
        (error <= 4 * distinct.HLL_ERROR * F.col("exact_users") + 1).alias("users_within"),
        (ranks[0] & ranks[1] & ranks[2]).alias("quartiles_within"),
    )


@query("""
WITH numbered AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS rn FROM events)
SELECT event_id, ts, user_id, event_type FROM numbered WHERE (rn + 1) % 8 = 0
AND ts IS NOT NULL AND user_id IS NOT NULL AND event_type IS NOT NULL
""")
def every_nth_row(spark, sf):
    return numbering.every_nth(
        table(spark, sf, "events"), ["ts", "event_id"], 8, ["event_id", "ts", "user_id", "event_type"]
    )


@query("""
WITH numbered AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events)
SELECT event_id, ts, user_id FROM numbered WHERE (rn + 1) % 8 = 0 AND ts IS NOT NULL AND user_id IS NOT NULL
""")
def every_nth_row_per_file(spark, sf):
    return numbering.every_nth(
        table(spark, sf, "events"), ["ts", "event_id"], 8, ["event_id", "ts", "user_id"], within="event_type",
    )


@query("""
SELECT event_id, user_id, event_type FROM events
ORDER BY md5(CAST(event_id AS VARCHAR) || '|0'), event_id LIMIT 100
""")
def seeded_sample(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return numbering.seeded_sample(events, "event_id", 100)


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_field_extract(spark, sf):
    return table(spark, sf, "events").select("event_id", text.json_member("props", "$.k").cast("int").alias("k"))


@query("""
SELECT page_id, url, list_extract(string_split(url, '/'), -1) AS file_name,
       regexp_matches(url, '^https?://', 'i') AS is_valid
FROM pages
""")
def url_manifest(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", "url", text.last_segment("url").alias("file_name"), text.has_scheme("url").alias("is_valid")
    )


@query("""
SELECT count(DISTINCT list_extract(string_split(url, '/'), -1)) AS n_files, count(*) AS n_urls FROM pages
WHERE regexp_matches(url, '^https?://', 'i')
""")
def file_count(spark, sf):
    valid = table(spark, sf, "pages").where(text.has_scheme("url"))
    return valid.agg(F.countDistinct(text.last_segment("url")).alias("n_files"), F.count("*").alias("n_urls"))


@query("""
SELECT o_orderkey, d AS o_orderdate, CASE WHEN d < TIMESTAMP '1998-01-01' THEN o_totalprice
       ELSE o_totalprice * 100 END AS amount,
       CASE WHEN d < TIMESTAMP '1998-01-01' THEN 'old' ELSE 'new' END AS system
FROM (SELECT *, CASE WHEN o_orderkey % 9 <> 4 THEN o_orderdate END AS d FROM orders)
""")
def cutover_union(spark, sf):
    """Both branches of a cut-over; some orders have no date."""
    dated = F.when(F.col("o_orderkey") % 9 != 4, F.col("o_orderdate")).alias("o_orderdate")
    orders = table(spark, sf, "orders").select("o_orderkey", dated, F.col("o_totalprice").alias("amount"))
    return cutover(
        orders,
        "o_orderdate",
        "1998-01-01",
        old=lambda df: df.withColumn("system", F.lit("old")),
        new=lambda df: df.withColumn("amount", F.col("amount") * 100).withColumn("system", F.lit("new")),
    )


GRID = """
WITH grid AS (
  SELECT source, CAST(unnest(generate_series(TIMESTAMP '2023-12-31', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS day
  FROM (SELECT DISTINCT event_type AS source FROM events)
), c AS (
  SELECT event_type AS source, CAST(ts AS DATE) AS day, count(*) AS n, count(*) FILTER (hour(ts) = 23) AS m
  FROM events GROUP BY 1, 2
)
SELECT grid.source, grid.day, CAST(coalesce(n, 0) AS BIGINT) AS n_rows, coalesce(n > 0 AND m > 0, false) AS ready
FROM grid LEFT JOIN c ON c.source = grid.source AND c.day = grid.day
"""


@query(GRID)
def readiness_grid(spark, sf):
    events = table(spark, sf, "events")
    grid = intervals.expected_grid(events, "event_type", "2023-12-31", "2024-02-01")
    # A day's last hour stands for the completion marker.
    return intervals.readiness(grid, events, events.where(F.hour("ts") == 23), "event_type", "ts")


@query(f"""
WITH ready AS ({GRID}), missing AS (
  SELECT source, day, day - CAST(row_number() OVER (PARTITION BY source ORDER BY day) AS INTEGER) AS run
  FROM ready WHERE NOT ready
)
SELECT source, min(day) AS first_day, max(day) AS last_day, count(*) AS n_days FROM missing GROUP BY source, run
""")
def missing_runs(spark, sf):
    return intervals.missing_runs(readiness_grid(spark, sf))


@query("""
SELECT CAST(ts AS DATE) AS date, user_id AS "user", count(*) AS n_events
FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL GROUP BY 1, 2
""")
def rerun_missing(spark, sf):
    """Days that a run has left out are found from what is stored, and run again; the others stay."""
    events, path = table(spark, sf, "events"), fresh_dir(spark, "reruns")
    for start, end in (("2024-01-01", "2024-01-09"), ("2024-01-13", "2024-01-14"), ("2024-01-22", "2024-03-01")):
        event_plans.backfill_stats(events, "ts", "user_id", start, end, path)
    stored = spark.read.schema("user bigint, n_events bigint, date date").parquet(path)
    stored = stored.select(F.lit("events").alias("source"), F.col("date").cast("timestamp_ntz").alias("ts"))
    # A day is expected if there are events of that day, and ready if statistics are stored.
    grid = intervals.expected_grid(stored, "source", "2024-01-01", "2024-02-01")
    ready = intervals.readiness(grid, stored, stored, "source", "ts")
    event_plans.rerun_missing(events, "ts", "user_id", intervals.missing_runs(ready), path)
    return spark.read.schema("user bigint, n_events bigint, date date").parquet(path).select("date", "user", "n_events")


@query("""
SELECT CAST(g AS DATE) AS day, EXISTS (SELECT 1 FROM events WHERE CAST(ts AS DATE) = CAST(g AS DATE)) AS has_data
FROM (SELECT unnest(generate_series(TIMESTAMP '2023-12-31', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS g)
""")
def interval_has_data(spark, sf):
    return intervals.has_data(table(spark, sf, "events"), "ts", "2023-12-31", "2024-02-01")


@query("SELECT * FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)")
def latest_interval(spark, sf):
    return intervals.latest_day(table(spark, sf, "events"), "ts")


@query("SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-18' AND ts < TIMESTAMP '2024-01-19'")
def latest_complete_interval(spark, sf):
    # At midnight the run of the day before is not yet due.
    return intervals.latest_complete_day(table(spark, sf, "events"), "ts", "2024-01-20 00:00:00")


@query("""
SELECT event_type AS source, count(*) AS n_rows, count(DISTINCT user_id) AS n_users, round(avg("value") + 1.3e-7, 4) AS avg_value,
       min(ts) AS first_ts, max(ts) AS last_ts
FROM events GROUP BY 1
""")
def source_metrics(spark, sf):
    metrics = intervals.source_metrics(table(spark, sf, "events"), "event_type", "user_id", "value", "ts")
    return rounded(metrics, "avg_value")


@query("""
WITH every AS (
  SELECT 'events' AS source, user_id AS u, "value" AS v, ts FROM events
  UNION ALL SELECT 'orders', o_custkey, o_totalprice, o_orderdate FROM orders
  UNION ALL SELECT 'lineitem', l_suppkey, l_extendedprice, l_shipdate FROM lineitem
)
SELECT source, count(*) AS n_rows, count(DISTINCT u) AS n_users, round(avg(v) + 1.3e-7, 4) AS avg_value,
       min(ts) AS first_ts, max(ts) AS last_ts
FROM every GROUP BY 1
""")
def dataset_metrics(spark, sf):
    columns = {
        "events": ("user_id", "value", "ts"),
        "orders": ("o_custkey", "o_totalprice", "o_orderdate"),
        "lineitem": ("l_suppkey", "l_extendedprice", "l_shipdate"),
    }
    every = union_all(*[intervals.dataset(table(spark, sf, name), name, *cols) for name, cols in columns.items()])
    return rounded(intervals.source_metrics(every, "source", "user", "value", "ts"), "avg_value")


@query("""
WITH c AS (SELECT CAST(ts AS DATE) AS day, event_type AS source, count(*) AS n_rows FROM events GROUP BY 1, 2)
SELECT day, source, n_rows, n_rows - lag(n_rows) OVER (PARTITION BY source ORDER BY day) AS difference FROM c
""")
def daily_difference(spark, sf):
    return intervals.daily_difference(table(spark, sf, "events"), "ts", "event_type")


@query("""
WITH p AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n_purchases FROM events WHERE event_type = 'purchase' GROUP BY 1),
v AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n_views FROM events WHERE event_type = 'view' GROUP BY 1)
SELECT p.day, n_purchases, n_views FROM p JOIN v ON p.day = v.day
""")
def join_daily_datasets(spark, sf):
    events = table(spark, sf, "events")
    purchases, views = (events.where(F.col("event_type") == kind) for kind in ("purchase", "view"))
    return intervals.join_daily(purchases, views, "ts", "n_purchases", "n_views")


@query("""
WITH m AS (SELECT date_trunc('minute', ts) AS t, count(*) AS n FROM events GROUP BY 1)
SELECT a.t AS interval_start, a.n AS n_rows, b.t AS later_start, b.n AS later_rows
FROM m a JOIN m b ON b.t = a.t + INTERVAL 4 HOUR
""")
def offset_interval_join(spark, sf):
    return intervals.offset_join(table(spark, sf, "events"), "ts", "minute", F.expr("interval 4 hour"))


@query("SELECT * FROM events")
def dedup_overlap(spark, sf):
    events = table(spark, sf, "events")
    # Two extracts whose windows overlap deliver the rows of the overlap twice.
    first = filters.in_interval(events, "ts", end="2024-01-20")
    second = filters.in_interval(events, "ts", start="2024-01-10")
    return deduplicate(union_all(first, second))


@query("""
SELECT o_orderkey AS id, o_orderdate AS ts, o_totalprice AS amount, CAST(NULL AS VARCHAR) AS event_type FROM orders
UNION ALL SELECT event_id, ts, "value", event_type FROM events
""")
def union_by_name(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("amount")
    )
    events = table(spark, sf, "events").select(
        "event_type", F.col("value").alias("amount"), "ts", F.col("event_id").alias("id")
    )
    return union_all(orders, events)


@query("SELECT count(*) AS n_rows FROM orders")
def row_count(spark, sf):
    return table(spark, sf, "orders").agg(F.count("*").alias("n_rows"))


@query("""
SELECT CAST(ts AS DATE) AS date, user_id AS "user", count(*) AS n_events
FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01' AND user_id IS NOT NULL GROUP BY 1, 2
""")
def interval_backfill(spark, sf):
    events = table(spark, sf, "events")
    out = fresh_dir(spark, "backfill")
    # One interval first, then the whole range over it: the second run replaces what the first one wrote.
    event_plans.backfill_stats(events, "ts", "user_id", "2024-01-05", "2024-01-06", out)
    # Three days that turn out to be of another range: they have no events when the range is run again.
    moved = events.withColumn("ts", F.expr("ts + INTERVAL 60 DAYS")).where("ts < timestamp_ntz'2024-03-04'")
    event_plans.backfill_stats(moved, "ts", "user_id", "2024-03-01", "2024-03-05", out)
    gone = event_plans.backfill_stats(events, "ts", "user_id", "2024-03-01", "2024-03-05", out)
    if not gone.isEmpty():
        raise RuntimeError("days without events are still stored")
    return event_plans.backfill_stats(events, "ts", "user_id", "2024-01-01", "2024-02-01", out)
