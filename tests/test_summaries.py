"""Bitmaps and sketches per day, merged over ranges, and ride subtotals, against plain counts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from benchqueries import intervals
from tidemark.operators import distinct
from tidemark.plans import rides

DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(12)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    rows = [(rng.choice("ab"), rng.choice(DAYS), rng.randrange(-9, 400) * 10**12, rng.gauss(0, 10)) for _ in range(3000)]
    # One key holds a third of all rows; NULLs in every column.
    rows += [("hot", rng.choice(DAYS), rng.randrange(90_000), rng.random()) for _ in range(1500)]
    return rows + [(None, DAYS[0], 5, 1.0), ("a", None, 6, 1.0), ("a", DAYS[0], None, 1.0), ("b", DAYS[1], 7, None), ("void", DAYS[2], 9, None)]


@pytest.fixture(scope="module")
def events(spark, rows):
    df = spark.createDataFrame(rows, "kind string, day date, user long, value double")
    return df.withColumn("ts", F.col("day").cast("timestamp_ntz")).drop("day").repartition(6)


RANGES = [("all", DAYS[0], DAYS[-1]), ("one", DAYS[3], DAYS[3]), ("over", DAYS[2], DAYS[6]), ("lap", DAYS[4], DAYS[9]), ("none", DAYS[5], DAYS[4])]


@pytest.fixture(scope="module")
def ranges(spark):
    return spark.createDataFrame(RANGES, "range string, first date, last date")


def held(rows, first, last):
    return [r for r in rows if r[1] is not None and first <= r[1] <= last]


def exact_users(rows):
    out = {}
    for name, first, last in RANGES:
        for kind in {r[0] for r in rows}:
            users = {r[2] for r in held(rows, first, last) if r[0] == kind and r[2] is not None}
            if users:
                out[name, kind] = len(users)
    return out


def counted(found):
    return {(r["range"], r["kind"]): r["n_users"] for r in found.collect()}


def test_bitmaps_count_exactly_over_overlapping_ranges(events, ranges, rows):
    numbers = distinct.user_numbers(events, "user")
    given = sorted(r["number"] for r in numbers.collect())
    assert given == list(range(len({r[2] for r in rows if r[2] is not None})))
    bitmaps = distinct.day_bitmaps(events, ["kind"], "ts", "user", numbers)
    expected = {k: n for k, n in exact_users(rows).items() if k[1] is not None}
    found = counted(distinct.distinct_in_ranges(bitmaps, ["kind"], ranges))
    assert {k: n for k, n in found.items() if k[1] is not None} == expected


def test_bitmaps_of_numbers_that_lie_densely_need_no_table(spark, ranges):
    rows = [("x", DAYS[i % 12], i * 7 % 70_000 - 5, 0.0) for i in range(20_000)]
    df = spark.createDataFrame(rows, "kind string, ts date, user long, value double")
    bitmaps = distinct.day_bitmaps(df, ["kind"], "ts", "user")
    assert bitmaps.select("bucket").distinct().count() >= 3
    assert counted(distinct.distinct_in_ranges(bitmaps, ["kind"], ranges)) == exact_users(rows)


def test_numbers_given_before_stay(spark, events, ranges, rows):
    early = events.where(F.col("ts") < F.lit(DAYS[6]))
    before = distinct.user_numbers(early, "user")
    after = distinct.user_numbers(events, "user", before)
    assert set(map(tuple, before.collect())) <= set(map(tuple, after.collect()))
    assert sorted(r["number"] for r in after.collect()) == list(range(after.count()))
    # Bitmaps of the early days, made with the early numbers, merge with later ones.
    late = events.where(F.col("ts") >= F.lit(DAYS[6]))
    both = distinct.day_bitmaps(early, ["kind"], "ts", "user", before).unionByName(
        distinct.day_bitmaps(late, ["kind"], "ts", "user", after)
    )
    found = counted(distinct.distinct_in_ranges(both, ["kind"], ranges))
    assert {k: n for k, n in found.items() if k[1]} == {k: n for k, n in exact_users(rows).items() if k[1]}
    assert distinct.user_numbers(events.where("false"), "user").count() == 0
    assert distinct.user_numbers(events, "user", before.where("false")).count() == after.count()


def test_sketches_keep_to_their_bounds(events, ranges, rows):
    sketches = distinct.day_sketches(events, ["kind"], "ts", "user", "value")
    found = distinct.sketches_in_ranges(sketches, ["kind"], ranges, [0.1, 0.5, 0.9])
    exact = exact_users(rows)
    seen = {(r["range"], r["kind"]): r for r in found.collect()}
    assert not any(k[0] == "none" for k in seen)
    for (name, kind), row in seen.items():
        first, last = {n: (f, l) for n, f, l in RANGES}[name]
        own = [r for r in held(rows, first, last) if r[0] == kind]
        assert row["n_rows"] == len(own)
        users = exact.get((name, kind), 0)
        assert abs(row["n_users"] - users) <= 4 * distinct.HLL_ERROR * users + 1
        values = sorted(r[3] for r in own if r[3] is not None)
        if not values:
            assert row["values_at"] is None
            continue
        for q, v in zip([0.1, 0.5, 0.9], row["values_at"]):
            slack = 2 * distinct.KLL_RANK_ERROR + 1 / len(values)
            assert sum(x < v for x in values) / len(values) <= q + slack
            assert sum(x <= v for x in values) / len(values) >= q - slack


def test_exact_counts_need_no_numbers(events, ranges, rows, monkeypatch):
    expected = exact_users(rows)
    for size in (distinct.TASK_ROWS, 100):
        monkeypatch.setattr(distinct, "TASK_ROWS", size)
        assert counted(distinct.exact_in_ranges(events, ["kind"], "ts", "user", ranges)) == expected
    assert counted(distinct.exact_in_ranges(events.where("false"), ["kind"], "ts", "user", ranges)) == {}


def test_sketches_are_checked_without_a_row_per_range(spark, events, tmp_path):
    own = events.select(F.col("user").alias("event_id"), "ts", F.col("kind").alias("event_type"), "value")
    # A key whose users are all NULL has a row of its own.
    own = own.unionByName(own.limit(3).withColumns({"event_id": F.lit(None), "event_type": F.lit("nobody")}))
    own.write.parquet(f"{tmp_path}/events.parquet")
    found = intervals.distinct_by_sketch(spark, str(tmp_path))
    # Rows repeated for the ranges that hold them are never grouped by id, which would hold seven of each in memory.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    grouped = [line for line in plan.splitlines() if "Aggregate [" in line]
    assert grouped and not any("range#" in line.split("]")[0] and "event_id#" in line for line in grouped)
    got = {(r["range"], r.event_type): r for r in found.collect()}
    rows = [r for r in own.collect() if r.ts is not None and r.event_type is not None]
    days = {r.ts.date() for r in rows}
    expected = {}
    for last in days:
        for r in rows:
            if 0 <= (last - r.ts.date()).days < 7:
                expected.setdefault((last, r.event_type), []).append(r.event_id)
    assert set(got) == set(expected)
    for key, ids in expected.items():
        assert (got[key].n_rows, got[key].exact_users) == (len(ids), len({i for i in ids if i is not None}))
        assert got[key].users_within


def test_trailing_ranges_end_with_every_day(events):
    found = sorted(map(tuple, distinct.trailing_ranges(events, "ts", 3).collect()))
    assert found == [(d, d - dt.timedelta(days=2), d) for d in DAYS]


def test_subtotals_tell_unknown_zones_from_all_zones(spark):
    at = dt.datetime(2024, 1, 6, 8, 30)
    given = [(1, 2, at, 10), (1, 2, at, 20), (None, 2, at, 40), (None, None, at, None)]
    df = spark.createDataFrame(given, "start_location_id int, end_location_id int, stoptime timestamp_ntz, tripduration int")
    found = rides.ride_subtotals(df).collect()
    by = {(r.start_location_id, r.end_location_id, r.weekday, r.time_group, r.grouping_id): r for r in found}
    assert len(by) == len(found)
    total = by[None, None, None, None, 15]
    assert (total.n_rides, total.total_seconds, total.avg_seconds) == (4, 70.0, 70 / 3)
    unknown = by[None, None, None, None, 7]
    assert (unknown.n_rides, unknown.total_seconds) == (2, 40.0)
    assert by[None, 2, None, None, 3].n_rides == 1 and by[None, 2, None, None, 11].n_rides == 3
    assert by[1, 2, 6, "8 AM - 11 AM", 0].avg_seconds == 15.0
    assert by[None, None, 6, "8 AM - 11 AM", 0].avg_seconds is None
    assert {r.grouping_id for r in found} == {0, 1, 3, 7, 11, 12, 14, 15}
    pair = rides.ride_subtotals(df, [["weekday"], []]).collect()
    assert {(r.weekday, r.grouping_id, r.n_rides) for r in pair} == {(6, 13, 4), (None, 15, 4)}


def test_subtotals_expand_once(spark):
    df = spark.createDataFrame([], "start_location_id int, end_location_id int, stoptime timestamp_ntz, tripduration int")
    subtotals = rides.ride_subtotals(df)
    plan = subtotals._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Expand") == 1
    # Over no rows only the grand total is left, as in SQL.
    assert [tuple(r)[5:] for r in subtotals.collect()] in ([], [(0, None, None)])
