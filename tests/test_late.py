"""Late rows become corrections, and interval streams meet, over several micro-batches."""

import collections
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import intervals
from tidemark.streaming import files as streams, late

SCHEMA = "id long, ts timestamp"
START = 1609459200


def arrive(spark, path, minutes):
    rows = [(i, dt.datetime.fromtimestamp(START + m * 60, dt.timezone.utc) if m is not None else None) for i, m in enumerate(minutes)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def quarters(minutes):
    return collections.Counter(START + m // 15 * 900 for m in minutes if m is not None)


BATCHES = [[*range(0, 100), *[40] * 300, None], [*range(100, 200), 98], [*range(200, 300), 5, 5, 31, 299], [150, 7, 301, 302]]


@pytest.fixture()
def counted(spark, tmp_path):
    landing, out, log = (str(tmp_path / name) for name in ("landing", "out", "log"))
    for minutes in BATCHES:
        arrive(spark, landing, minutes)

    def run():
        stream = streams.landing_stream(spark, landing, SCHEMA, files_per_batch=1)
        late.store(late.counts_and_corrections(stream, "ts", "30 minutes"), out, log)
        return late.interval_totals(spark, out, log)

    return landing, run


def totals(df):
    return {int(r["interval_start"].timestamp()): r for r in df.collect()}


def test_counts_and_corrections_equal_the_batch(spark, counted):
    landing, run = counted
    found = totals(run())
    everything = [m for batch in BATCHES for m in batch]
    assert {k: r["n_events"] for k, r in found.items()} == quarters(everything)
    # Minutes 5 and 31 came when 200 had passed, 7 and 150 when 299 had; 98 was within the delay.
    assert {(k - START) // 60: r["n_late"] for k, r in found.items() if r["n_late"]} == {0: 3, 30: 1, 150: 1}
    # The newest row is minute 302; intervals that end within 30 minutes of it are still counted.
    assert {(k - START) // 60 for k, r in found.items() if r["is_open"]} == {270, 285, 300}


def test_a_later_run_corrects_what_an_earlier_one_gave_out(spark, counted):
    landing, run = counted
    run()
    arrive(spark, landing, [0, 0, 290, 400])
    found = totals(run())
    everything = [m for batch in BATCHES for m in batch] + [0, 0, 290, 400]
    assert {k: r["n_events"] for k, r in found.items()} == quarters(everything)
    assert found[START]["n_late"] == 5 and found[START + 285 * 60]["n_late"] == 0
    assert {k: r["n_events"] for k, r in totals(run()).items()} == quarters(everything)


def test_offset_join_of_streams_equals_the_batch_join(spark, tmp_path):
    landing = str(tmp_path / "landing")
    rows = [(START + 60 * m, m % 7 + 1) for m in range(0, 900) if m % 11]
    for first in range(0, len(rows), 200):
        part = spark.createDataFrame(rows[first : first + 200], "s long, n long").select(F.timestamp_seconds("s").alias("ts"), "n")
        part.coalesce(1).write.mode("append").parquet(landing)
    schema = "ts timestamp, n long"
    both = [streams.landing_stream(spark, landing, schema, files_per_batch=1) for _ in range(2)]
    pairs = late.offset_join(*both, "ts", "n", "2 hours", "1 hour")
    found = streams.ingest(pairs, str(tmp_path / "out"), str(tmp_path / "log"))
    events = spark.read.schema(schema).parquet(landing).select("ts", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    expected = intervals.offset_join(events, "ts", "minute", F.expr("interval 2 hours"))
    assert sorted(map(tuple, found.select(*expected.columns).collect())) == sorted(map(tuple, expected.collect()))


def test_the_state_of_the_join_is_bounded(spark, tmp_path):
    landing = str(tmp_path / "landing")
    for first in range(0, 5000, 500):
        part = spark.range(first, first + 500, 1, 1).select(F.timestamp_seconds(F.col("id") * 60).alias("ts"), F.lit(1).cast("long").alias("n"))
        part.write.mode("append").parquet(landing)
    both = [streams.landing_stream(spark, landing, "ts timestamp, n long", files_per_batch=1) for _ in range(2)]
    pairs = late.offset_join(*both, "ts", "n", "1 hour", "10 minutes")
    query = (
        pairs.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert held and max(held) < 3000 and held[-1] < 1500
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5000 - 60
