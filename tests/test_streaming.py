"""Streams equal the batch result, over several micro-batches and repeated runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.streaming import files as streams

SCHEMA = "id long, ts timestamp"
START = dt.datetime(2021, 1, 1)


@pytest.fixture()
def landing(spark, tmp_path):
    """Four files in order of time; each repeats the last ten rows of the one before."""
    path = str(tmp_path / "landing")
    for i in range(4):
        first = max(0, i * 100 - 10)
        part = spark.range(first, (i + 1) * 100, 1, 1).withColumn(
            "ts", F.timestamp_seconds(F.lit(1609459200) + F.col("id") * 60)
        )
        part.write.mode("append").parquet(path)
    return path


def stream(spark, path):
    return streams.landing_stream(spark, path, SCHEMA, name_glob="*.parquet", files_per_batch=1)


def test_ingest_takes_each_file_once(spark, landing, tmp_path):
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    assert streams.ingest(stream(spark, landing), out, log).count() == 430
    assert streams.ingest(stream(spark, landing), out, log).count() == 430
    spark.range(1).withColumn("ts", F.current_timestamp()).write.mode("append").parquet(landing)
    assert streams.ingest(stream(spark, landing), out, log).count() == 431


def test_counts_over_batches_equal_batch_counts(spark, landing, tmp_path):
    counts = streams.quarter_hour_counts(stream(spark, landing), "ts", "10 days")
    found = streams.upsert(counts, ["interval_start"], ["n_events"], str(tmp_path / "out"), str(tmp_path / "log"))
    batch = (
        spark.read.schema(SCHEMA).parquet(landing)
        .groupBy(F.window("ts", "15 minutes").start.alias("interval_start"))
        .agg(F.count("*").alias("n_events"))
    )
    assert set(map(tuple, found.collect())) == set(map(tuple, batch.collect()))


def test_redelivered_rows_are_dropped(spark, landing, tmp_path):
    once = streams.deduplicated(stream(spark, landing), ["id"], "ts", "1 day")
    found = streams.ingest(once, str(tmp_path / "out"), str(tmp_path / "log"))
    assert sorted(r["id"] for r in found.collect()) == list(range(400))


def test_two_batches_of_one_day_do_not_overwrite_each_other(spark, landing, tmp_path):
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    found = streams.partition_sink(stream(spark, landing), "ts", out, log)
    assert found.count() == 430
    assert found.where(F.col("day") != F.col("ts").cast("date")).count() == 0


def test_a_repeated_batch_changes_nothing(spark, landing, tmp_path):
    out = str(tmp_path / "out")
    first = streams.partition_sink(stream(spark, landing), "ts", out, str(tmp_path / "log1")).count()
    # A lost checkpoint replays every batch under its old number.
    assert streams.partition_sink(stream(spark, landing), "ts", out, str(tmp_path / "log2")).count() == first


def test_nothing_has_arrived_yet(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    empty = stream(spark, str(tmp_path / "landing"))
    assert streams.ingest(empty, str(tmp_path / "a"), str(tmp_path / "log-a")).count() == 0
    counts = streams.quarter_hour_counts(empty, "ts", "1 day")
    assert streams.upsert(counts, ["interval_start"], ["n_events"], str(tmp_path / "b"), str(tmp_path / "log-b")).count() == 0
    assert streams.partition_sink(empty, "ts", str(tmp_path / "c"), str(tmp_path / "log-c")).count() == 0


def test_a_row_behind_the_watermark_is_not_counted(spark, tmp_path):
    landing = str(tmp_path / "landing")
    for moment in ("2021-01-01 00:00:00", "2021-01-01 12:00:00", "2021-01-01 00:05:00", "2021-01-01 11:55:00"):
        spark.sql(f"SELECT 1L AS id, timestamp'{moment}' AS ts").coalesce(1).write.mode("append").parquet(landing)
        counts = streams.quarter_hour_counts(stream(spark, landing), "ts", "1 hour")
        found = streams.upsert(counts, ["interval_start"], ["n_events"], str(tmp_path / "out"), str(tmp_path / "log"))
    by_start = {r["interval_start"].strftime("%H:%M"): r["n_events"] for r in found.collect()}
    assert by_start == {"00:00": 1, "12:00": 1, "11:45": 1}


def test_newest_versions_are_compacted_and_run_on(spark, landing, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "COMPACT_EVERY", 3)
    out, log = str(tmp_path / "out"), str(tmp_path / "log")

    def run():
        counts = streams.quarter_hour_counts(stream(spark, landing), "ts", "10 days")
        return set(map(tuple, streams.upsert(counts, ["interval_start"], ["n_events"], out, log).collect()))

    def batch():
        start = F.window("ts", "15 minutes").start
        return set(map(tuple, spark.read.schema(SCHEMA).parquet(landing).groupBy(start).count().collect()))

    assert run() == batch()
    first = streams._numbers(spark, f"{out}/newest")
    assert len(first) == 1 and run() == batch()
    for hour in (3, 3, 9):
        part = spark.range(5).withColumn("ts", F.lit(START + dt.timedelta(hours=hour)).cast("timestamp"))
        part.coalesce(1).write.mode("append").parquet(landing)
        assert run() == batch()
    assert len(streams._numbers(spark, f"{out}/newest")) >= 2
