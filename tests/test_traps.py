"""Literal cases for the semantics that are easy to get wrong."""

import datetime as dt
import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text, times
from tidemark.operators import filters, intervals, numbering
from tidemark.operators.tables import cutover, deduplicate, lookup, union_all, with_small
from tidemark.plans import events, listings, pageviews, ratings, rides


def rows(df):
    return [tuple(r) for r in df.collect()]


def ts(text_):
    return dt.datetime.fromisoformat(text_)


@pytest.fixture(scope="module")
def six_ratings(spark):
    return spark.createDataFrame(
        [(1, 10, 5.0), (1, 11, 4.0), (2, 10, 3.0), (2, 11, 4.0), (2, 12, 5.0), (2, 12, 1.0), (None, 12, 5.0)],
        "movieId long, userId long, rating double",
    )


def test_ranking_needs_strictly_more_users_and_counts_them_once(six_ratings):
    ranked = ratings.rank_items(six_ratings, "movieId", "userId", "rating")
    assert rows(ranked) == [(2, 3.25, 3)]


def test_ranking_sorts_by_rating_then_users(spark):
    data = [(i, u, r) for i, users, r in [(1, 3, 4.0), (2, 4, 4.0), (3, 3, 5.0)] for u in range(users)]
    ranked = ratings.rank_items(spark.createDataFrame(data, "i long, u long, r double"), "i", "u", "r")
    assert [r[0] for r in rows(ranked)] == [3, 2, 1]


def test_empty_ranking_is_typed(spark):
    empty = spark.createDataFrame([], "movieId long, userId long, rating double")
    ranked = ratings.rank_items(empty, "movieId", "userId", "rating")
    assert ranked.schema.simpleString() == "struct<movieId:bigint,avg_rating:double,num_ratings:bigint>"
    assert rows(ranked) == []


def test_warehouse_ranking_counts_all_rows_without_minimum(spark):
    data = [(1, 10, 5.0, ts("2019-01-01T23:59:59")), (1, 10, 3.0, ts("2019-01-02")), (2, 11, 1.0, ts("2018-05-05"))]
    df = spark.createDataFrame(data, "m long, u long, r double, ts timestamp_ntz")
    expected = [(1, 5.0, 1), (2, 1.0, 1)]
    assert rows(ratings.cumulative_ranking(df, "m", "r", "ts", "2019-01-01")) == expected
    assert rows(ratings.cumulative_ranking_sql(df, "m", "r", "ts", "2019-01-01")) == expected


def test_event_stats_drop_null_keys(spark):
    df = spark.createDataFrame(
        [("2021-01-01", "a"), ("2021-01-01", "a"), ("2021-01-01", None), (None, "a")], "date string, user string"
    ).withColumn("date", F.to_date("date"))
    assert rows(events.event_stats(df)) == [(dt.date(2021, 1, 1), "a", 2)]


def test_tracked_pages_last_line_wins_and_absent_is_zero(spark):
    df = spark.createDataFrame(
        [(1, "en", "A", 5), (2, "en", "A", 3), (3, "de", "B", 9), (4, "en", "C", 7)],
        "line long, domain_code string, page_title string, view_counts int",
    )
    found = pageviews.tracked_views(df, ["A", "B"], "en", ["line"])
    assert sorted(rows(found)) == [("A", 3), ("B", 0)]


def test_tracked_pages_of_many_dumps(spark):
    df = spark.createDataFrame(
        [(1, "en", "A", 5, ts("2021-01-01")), (2, "en", "A", 3, ts("2021-01-01")), (3, "de", "A", 9, ts("2021-01-02"))],
        "line long, domain_code string, page_title string, view_counts int, hour timestamp_ntz",
    )
    found = pageviews.tracked_views_per_interval(df, ["A", "B"], "en", ["line"], "hour")
    first, second = ts("2021-01-01"), ts("2021-01-02")
    assert sorted(rows(found)) == [("A", 0, second), ("A", 3, first), ("B", 0, first), ("B", 0, second)]


def test_best_hour_takes_the_earlier_of_equals(spark):
    df = spark.createDataFrame(
        [("p", 4, ts("2021-01-01T05:10:00")), ("p", 4, ts("2021-01-02T03:10:00")), ("p", 1, ts("2021-01-02T01:00:00"))],
        "page string, views int, ts timestamp_ntz",
    )
    assert rows(pageviews.best_hour(df, "page", "views", "ts")) == [("p", 3, 4.0)]


# --- price change -------------------------------------------------------------------------------------------------


def brute_pairs(data):
    """Every (first-day row, last-day row) pair of each id, in plain Python."""
    out = []
    for key in sorted({d[0] for d in data}):
        mine = [d for d in data if d[0] == key]
        first, last = min(d[2] for d in mine), max(d[2] for d in mine)
        if first != last:
            old = [d[1] for d in mine if d[2] == first]
            new = [d[1] for d in mine if d[2] == last]
            days = (last - first).days
            for o, n in itertools.product(old, new):
                out.append((key, first, o, last, n, None if o is None or n is None else (n - o) / days))
    return out


def ordered(pairs, rising):
    def key(p):
        change = p[5]
        null = lambda v: (v is not None, v if v is not None else 0)  # noqa: E731  NULL price first
        return (change is None, 0 if change is None else (-change if rising else change), p[0], null(p[2]), null(p[4]))

    return sorted(pairs, key=key)


LISTING_SCHEMA = "id long, price double, date date"


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("rising", [True, False])
def test_top_changes_equal_all_pairs(spark, seed, rising):
    rng = random.Random(seed)
    day = dt.date(2020, 1, 1)
    ids = rng.choice([2, 4, 9])
    data = [
        (
            rng.randrange(ids),
            rng.choice([None, *map(float, range(6))]),
            day + dt.timedelta(days=rng.randrange(3)),
        )
        for _ in range(rng.choice([3, 12, 60]))
    ]
    df = spark.createDataFrame(data, LISTING_SCHEMA)
    found = rows(listings.top_changes(df, "id", "price", "date", rising=rising))
    assert found == ordered(brute_pairs(data), rising)[:5]


@pytest.mark.parametrize("seed", range(4))
def test_price_change_describes_all_pairs(spark, seed):
    rng = random.Random(100 + seed)
    day = dt.date(2020, 1, 1)
    data = [
        (rng.randrange(5), rng.choice([None, 1.0, 2.0, 4.0]), day + dt.timedelta(days=rng.randrange(4)))
        for _ in range(40)
    ]
    expected = {}
    for p in brute_pairs(data):
        expected.setdefault(p[0], []).append(p[5])
    found = listings.price_change(spark.createDataFrame(data, LISTING_SCHEMA), "id", "price", "date").collect()
    assert {r["id"] for r in found} == set(expected)
    for r in found:
        changes = [c for c in expected[r["id"]] if c is not None]
        assert r["n_pairs"] == len(expected[r["id"]])
        if changes:
            assert r["min_diff_per_day"] == pytest.approx(min(changes))
            assert r["max_diff_per_day"] == pytest.approx(max(changes))
            assert r["avg_diff_per_day"] == pytest.approx(sum(changes) / len(changes))
        else:
            assert r["min_diff_per_day"] is r["max_diff_per_day"] is r["avg_diff_per_day"] is None


def test_boundary_row_in_two_files_multiplies_and_single_date_is_left_out(spark):
    d1, d2 = dt.date(2021, 1, 1), dt.date(2021, 1, 11)
    january = spark.createDataFrame([(1, 100.0, d1), (2, 50.0, d1)], LISTING_SCHEMA)
    boundary = spark.createDataFrame([(1, 80.0, d2)], LISTING_SCHEMA)
    both = union_all(january, boundary, boundary)
    change = listings.price_change(both, "id", "price", "date").select("id", "n_pairs", "avg_diff_per_day")
    assert rows(change) == [(1, 2, -2.0)]
    assert len(rows(listings.top_changes(both, "id", "price", "date", rising=False))) == 2


def test_tie_at_rank_five_and_null_last(spark):
    d1, d2 = dt.date(2021, 1, 1), dt.date(2021, 1, 2)
    data = [(i, 0.0, d1) for i in range(1, 8)]
    data += [(1, None, d2), *[(i, 9.0, d2) for i in (2, 3, 4, 5)], (6, 1.0, d2), (7, 1.0, d2)]
    top = rows(listings.top_changes(spark.createDataFrame(data, LISTING_SCHEMA), "id", "price", "date"))
    assert [r[0] for r in top] == [2, 3, 4, 5, 6]


# --- rides ---------------------------------------------------------------------------------------------------------


def test_time_bands_at_their_edges(spark):
    hours = [7, 8, 10, 11, 15, 16, 18, 19, 21, 22]
    df = spark.createDataFrame([(dt.datetime(2021, 1, 1, h),) for h in hours], "ts timestamp_ntz")
    bands = [r[0] for r in df.select(times.time_band("ts")).collect()]
    night, morning, noon = "10 PM - 8 AM", "8 AM - 11 AM", "11 AM - 4 PM"
    assert bands == [night, morning, morning, noon, noon] + ["4 PM - 7 PM"] * 2 + ["7 PM - 10 PM"] * 2 + [night]


def test_weekday_starts_at_sunday_zero(spark):
    df = spark.createDataFrame([(ts("2021-08-22"),), (ts("2021-08-28"),)], "ts timestamp_ntz")
    number = times.weekday_number("ts")
    assert rows(df.select(number, times.weekday_name(number))) == [(0, "Sunday"), (6, "Saturday")]


def test_duration_truncates_toward_zero(spark):
    base = dt.datetime(2021, 1, 1)
    stops = [-1.5, 1.9, 0.0, 59.999999]
    df = spark.createDataFrame([(base, base + dt.timedelta(seconds=s)) for s in stops], "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(times.whole_seconds("a", "b")).collect()] == [-1, 1, 0, 59]


def test_taxi_rides_read_text_times_and_drop_the_distance(spark):
    df = spark.createDataFrame(
        [("2021-01-01 00:00:00", "2021-01-01 00:01:30", 1, 2, 3.5)],
        "pickup_datetime string, dropoff_datetime string, pickup_locationid int, dropoff_locationid int, trip_distance double",
    )
    found = rides.taxi_rides(df)
    assert found.columns == rides.RIDE_COLUMNS
    assert rows(found) == [(90, ts("2021-01-01"), 1, ts("2021-01-01T00:01:30"), 2)]


def test_fastest_mode_skips_null_and_equal_zones_and_reports_ties(spark):
    noon = dt.datetime(2021, 8, 22, 12)
    data = [
        ("bike", 1, 2, noon, 10), ("taxi", 1, 2, noon, 10), ("bike", 1, 3, noon, 5), ("taxi", 1, 3, noon, 6),
        ("bike", 1, 4, noon, 7), ("taxi", 1, 4, noon, 6), ("bike", None, 2, noon, 1), ("taxi", None, 2, noon, 1),
        ("bike", 5, 5, noon, 1), ("taxi", 5, 5, noon, 1), ("bike", 8, 9, noon, 1),
    ]
    df = spark.createDataFrame(
        data, "mode string, start_location_id int, end_location_id int, stoptime timestamp_ntz, tripduration int"
    )
    report = rides.fastest_mode(df, F.col("mode") == "bike").select("end_location_id", "weekday", "fastest")
    assert rows(report) == [(2, 0, "No difference"), (3, 0, "Citi Bike"), (4, 0, "Taxi")]


def test_bands_sort_as_text(spark):
    stops = [dt.datetime(2021, 8, 22, h) for h in (9, 23, 12)]
    data = [(m, 1, 2, s, 1) for m in ("bike", "taxi") for s in stops]
    df = spark.createDataFrame(
        data, "mode string, start_location_id int, end_location_id int, stoptime timestamp_ntz, tripduration int"
    )
    bands = [r["time_group"] for r in rides.fastest_mode(df, F.col("mode") == "bike").collect()]
    assert bands == ["10 PM - 8 AM", "11 AM - 4 PM", "8 AM - 11 AM"]


def test_lookup_uses_the_default(spark):
    names = spark.createDataFrame([(1, "Harbour")], "id int, name string")
    df = spark.createDataFrame([(1,), (2,), (None,)], "z int")
    found = lookup(df, "z", names, "id", "name", "zone", "Unknown zone name")
    assert sorted(r["zone"] for r in found.collect()) == ["Harbour", "Unknown zone name", "Unknown zone name"]


def test_lookup_by_shuffle_gives_the_same(spark):
    names = spark.range(50).select("id", F.concat(F.lit("zone "), "id").alias("name"))
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 80).alias("z"))
    found = lookup(df, "z", names, "id", "name", "zone", "none")
    expected = sorted(rows(found))
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = lookup(df, "z", names, "id", "name", "zone", "none")
        assert "BroadcastHashJoin" not in shuffled._jdf.queryExecution().executedPlan().toString()
        assert sorted(rows(shuffled)) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)


# --- filters and intervals -----------------------------------------------------------------------------------------


def test_half_open_and_closed_ranges(spark):
    days = [dt.datetime(2021, 1, d) for d in (1, 2, 3)]
    df = spark.createDataFrame([(d,) for d in days], "ts timestamp_ntz")
    assert filters.in_interval(df, "ts", "2021-01-01", "2021-01-03").count() == 2
    assert filters.in_interval(df, "ts", end="2021-01-03").count() == 2
    assert filters.in_interval(df, "ts").count() == 3
    assert filters.between(df, "ts", "2021-01-01", "2021-01-03").count() == 3


def test_epoch_zero_is_a_bound(spark):
    df = spark.createDataFrame([(-1,), (0,), (1,)], "s long")
    assert rows(filters.in_epoch_interval(df, "s", "1970-01-01")) == [(0,), (1,)]
    assert rows(df.select(times.epoch_date("s")))[0] == (dt.date(1969, 12, 31),)


def test_trailing_window_keeps_both_ends_and_rejects_other_periods(spark):
    now = dt.datetime(2021, 1, 1, 12)
    offsets = [0, 15 * 60, 15 * 60 + 1]
    df = spark.createDataFrame([(now - dt.timedelta(seconds=s),) for s in offsets], "ts timestamp_ntz")
    assert filters.trailing(df, "ts", 15, "minute").count() == 2
    assert filters.trailing(df, "ts", 1, "hour", now="2021-01-01 12:45:00").count() == 2
    with pytest.raises(ValueError):
        filters.trailing(df, "ts", 1, "week")


def test_retention_excludes_its_limit(spark):
    now = dt.datetime(2021, 1, 1, 12)
    df = spark.createDataFrame([(now - dt.timedelta(minutes=m),) for m in (0, 58, 59)], "ts timestamp_ntz")
    assert filters.retain(df, "ts").count() == 2


def test_december_window_rolls_over(spark):
    assert filters.month_bounds(2019, 12) == ("2019-12-01", "2020-01-01")
    assert filters.month_bounds(2020, 1) == ("2020-01-01", "2020-02-01")
    df = spark.createDataFrame([(ts("2019-12-31T23:59:59"),), (ts("2020-01-01"),)], "ts timestamp_ntz")
    assert filters.in_month(df, "ts", 2019, 12).count() == 1


def test_month_cut_off_compares_text(spark):
    df = spark.createDataFrame([("2018", "12"), ("2019", "02"), ("2019", "03"), ("2020", "01")], "y string, m string")
    assert rows(filters.until_month(df, "y", "m", 2019, 2)) == [("2018", "12"), ("2019", "02")]


def test_leap_day_shifts_to_the_28th(spark):
    df = spark.createDataFrame([(ts("2020-02-29T10:00:00"),)], "ts timestamp_ntz")
    assert rows(df.select(times.shift_years("ts", 1))) == [(ts("2021-02-28T10:00:00"),)]


def test_cutover_belongs_to_the_new_side(spark):
    df = spark.createDataFrame([(ts("2019-12-31"),), (ts("2020-01-01"),)], "ts timestamp_ntz")
    tagged = cutover(
        df, "ts", "2020-01-01",
        lambda old: old.withColumn("s", F.lit("old")), lambda new: new.withColumn("s", F.lit("new")),
    )
    assert sorted(r["s"] for r in tagged.collect()) == ["new", "old"]


def test_readiness_needs_data_and_marker(spark):
    data = spark.createDataFrame(
        [("a", ts("2021-01-01T01:00:00")), ("b", ts("2021-01-02"))], "source string, ts timestamp_ntz"
    )
    markers = spark.createDataFrame([("a", ts("2021-01-01")), ("b", ts("2021-01-01"))], data.schema)
    grid = intervals.expected_grid(data, "source", "2021-01-01", "2021-01-03")
    ready = intervals.readiness(grid, data, markers, "source", "ts")
    found = {(r["source"], r["day"].day): (r["n_rows"], r["ready"]) for r in ready.collect()}
    assert found == {("a", 1): (1, True), ("a", 2): (0, False), ("b", 1): (0, False), ("b", 2): (1, False)}


@pytest.mark.parametrize("now, day", [("2021-01-03 00:00:00", 1), ("2021-01-03 00:00:01", 2), ("2021-01-04 00:00:00", 2)])
def test_latest_run_begins_just_after_its_interval(spark, now, day):
    df = spark.createDataFrame([(dt.datetime(2021, 1, d, 23),) for d in (1, 2, 3)], "ts timestamp_ntz")
    assert rows(intervals.latest_complete_day(df, "ts", now)) == [(dt.datetime(2021, 1, day, 23),)]


def test_overlapping_extracts_are_deduplicated(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    assert deduplicate(union_all(df, df)).count() == 2
    assert deduplicate(union_all(df, df), ["id"]).count() == 2


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([(2.5, 2)], "extra double, id int")
    assert sorted(rows(union_all(a, b).select("id", "v", "extra"))) == [(1, "x", None), (2, None, 2.5)]


def test_urls(spark):
    df = spark.createDataFrame([("https://a.b/c/d.jpg",), ("a.b/d.png",), ("HTTP://x/",), (None,)], "u string")
    found = rows(df.select(text.last_segment("u"), text.has_scheme("u")))
    assert found == [("d.jpg", True), ("d.png", False), ("", True), (None, False)]


# --- numbering -----------------------------------------------------------------------------------------------------


def test_row_numbers_survive_a_hot_leading_value(spark):
    data = [(1 if i % 3 else i, i) for i in range(5000)]
    df = spark.createDataFrame(data, "k long, id long").repartition(7)
    numbered = numbering.number_rows(df, ["k", "id"]).collect()
    expected = {row: i + 1 for i, row in enumerate(sorted(data))}
    assert {(r["k"], r["id"]): r["row_number"] for r in numbered} == expected
    assert len(numbered) == 5000


def test_hot_leading_value_spreads_over_chunks(spark):
    df = spark.range(0, 200_000, 1, 8).select(F.lit(1).alias("k"), "id")
    ranged = df.repartitionByRange(4, "k", "id").groupBy(F.spark_partition_id()).count().collect()
    assert len(ranged) == 4 and max(r["count"] for r in ranged) < 100_000


def test_deep_page_equals_the_top_k_page(spark, monkeypatch):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    shallow = rows(numbering.page(df, ["k", "id"], 750, 20))
    monkeypatch.setattr(numbering, "TOP_K_ROWS", 10)
    deep = rows(numbering.page(df, ["k", "id"], 750, 20).orderBy("k", "id"))
    assert shallow == deep and shallow[0] == (7, 507, 1000)


def test_page_beyond_the_end_is_empty(spark):
    assert rows(numbering.page(spark.range(5), ["id"], 5, 10)) == []


def test_every_nth_counts_the_header_and_drops_nulls(spark):
    df = spark.createDataFrame([(i, None if i == 7 else i) for i in range(1, 16)], "id int, v int")
    assert rows(numbering.every_nth(df, ["id"], 4).orderBy("id")) == [(3, 3), (11, 11), (15, 15)]
    assert rows(numbering.every_nth(df, ["id"], 4, ["id"], header_lines=0).orderBy("id")) == [(4,), (8,), (12,)]


def test_every_nth_starts_anew_in_each_file(spark):
    df = spark.createDataFrame([(f, i) for f in ("a", "b") for i in range(1, 6)], "file string, id int")
    found = numbering.every_nth(df, ["id"], 3, header_lines=1, within="file")
    assert sorted(rows(found)) == [("a", 2), ("a", 5), ("b", 2), ("b", 5)]


def test_sample_has_exact_size_and_ignores_partitioning(spark):
    df = spark.range(500)
    one = rows(numbering.seeded_sample(df.repartition(1), "id", 50).orderBy("id"))
    many = rows(numbering.seeded_sample(df.repartition(9), "id", 50).orderBy("id"))
    other = rows(numbering.seeded_sample(df, "id", 50, seed=1).orderBy("id"))
    assert one == many and len(one) == 50 and one != other
    assert numbering.seeded_sample(df, "id", 900).count() == 500


@pytest.mark.parametrize("n", [10, 400, 5000])
def test_sample_is_the_n_smallest_hashes(spark, n):
    keys = [(hashlib.md5(f"{i}|3".encode()).hexdigest(), i) for i in range(20_000)]
    found = numbering.seeded_sample(spark.range(20_000), "id", n, seed=3)
    assert sorted(r["id"] for r in found.collect()) == sorted(i for _, i in sorted(keys)[:n])


def test_numbering_an_empty_table(spark, monkeypatch):
    empty = spark.range(0)
    assert rows(numbering.number_rows(empty, ["id"])) == []
    assert rows(numbering.every_nth(empty.withColumn("f", F.lit("a")), ["id"], 2, within="f")) == []
    assert rows(numbering.seeded_sample(empty, "id", 3)) == []
    monkeypatch.setattr(numbering, "TOP_K_ROWS", 1)
    assert rows(numbering.leading(empty, ["id"], 5)) == []


def test_scan_tasks_prune_before_they_hand_on(spark):
    df = spark.range(0, 10_000, 1, 40).select((F.col("id") % 3).alias("k"), "id")
    top = numbering.leading(df, ["k", "id"], 20, 30)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert [r["id"] for r in top.collect()] == list(range(90, 150, 3))


def test_broadcast_only_below_the_bound(spark):
    assert with_small(spark.range(10), 10)[1] is True
    big, small = with_small(spark.range(11), 10)
    assert small is False and big.count() == 11


def test_named_routes_come_in_order_without_broadcasts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        start = dt.datetime(2021, 1, 1, 9)
        data = [(s, e, start + dt.timedelta(days=d), m, 60.0) for s in range(12) for e in range(5) for d in (0, 3) for m in (True, False)]
        df = spark.createDataFrame(data, "start_location_id int, end_location_id int, stoptime timestamp_ntz, bike boolean, tripduration double")
        zones = spark.createDataFrame([(i, f"zone {i}") for i in range(0, 12, 2)], "zone int, name string")
        found = rides.named_routes(rides.fastest_mode(df, F.col("bike")), zones, "zone", "name").collect()
        keys = [tuple(r[c] for c in rides.ROUTE) for r in found]
        assert keys == sorted(keys) and len(keys) > 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_repeated_trips_count_once_in_the_report(spark):
    edges = [(z, *e) for z, x in ((1, 0.0), (2, 10.0)) for e in ((x, 0.0, x + 4, 0.0), (x + 4, 0.0, x + 4, 4.0), (x + 4, 4.0, x, 4.0), (x, 4.0, x, 0.0))]
    from tidemark.operators.spatial import zone_grid

    grid = zone_grid(spark.createDataFrame(edges, "zone_id int, x1 double, y1 double, x2 double, y2 double"), 2.0)
    bikes = [(i, 60 * i, "2021-01-01T09:00:00", "2021-01-01T09:30:00", 1.0, 1.0, 11.0, 1.0) for i in (1, 2)]
    bikes = spark.createDataFrame(bikes + bikes[:1], "id int, tripduration int, starttime string, stoptime string, start_station_longitude double, start_station_latitude double, end_station_longitude double, end_station_latitude double")
    taxis = [("Fri, 01 Jan 2021 09:00:00 GMT", "Fri, 01 Jan 2021 09:01:00 GMT", 1, 2, 1.0), ("2021-01-01 09:00:00", "2021-01-01T09:03:00", 1, 2, 1.0)]
    taxis = spark.createDataFrame(taxis + taxis[:1], "pickup_datetime string, dropoff_datetime string, pickup_locationid int, dropoff_locationid int, trip_distance double")
    zones = spark.createDataFrame([(1, "one")], "zone int, name string")
    (row,) = rides.ride_report(taxis, bikes, "id", grid, zones, "zone", "name").collect()
    assert (row["citibike_avg_seconds"], row["taxi_avg_seconds"], row["fastest"]) == (90.0, 120.0, "Citi Bike")


@pytest.mark.parametrize("n", [1, 5, 40])
def test_top_changes_for_larger_n_equal_all_pairs(spark, n):
    rng = random.Random(n)
    data = [(i, float(rng.randint(1, 9)), dt.date(2021, 1, d)) for i in range(6) for d in (1, 1, 1, 2, 9, 9, 9)]
    data = [(i, float(rng.randint(1, 9)), d) for i, _, d in data]
    df = spark.createDataFrame(data, "id int, price double, date date")
    pairs = []
    for i in range(6):
        old = [p for k, p, d in data if k == i and d.day == 1]
        new = [p for k, p, d in data if k == i and d.day == 9]
        pairs += [((b - a) / 8, i, a, b) for a in old for b in new]
    expected = sorted(pairs, key=lambda p: (-p[0], *p[1:]))[:n]
    found = [(r["price_diff_per_day"], r["id"], r["oldest_price"], r["latest_price"]) for r in listings.top_changes(df, "id", "price", "date", n=n).collect()]
    assert [f[0] for f in found] == [e[0] for e in expected]
    assert found == expected
