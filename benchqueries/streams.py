"""Streaming queries over the event table as a landing folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from benchqueries import ltz, query, table
from tidemark.session import fresh_dir
from tidemark.sources.paginated import ParquetPages, stream_pages
from tidemark.streaming import files as streams, late


def _events(spark, sf):
    schema = table(spark, sf, "events").schema
    # The wildcard lets the table be one file or a folder of files.
    stream = streams.landing_stream(spark, f"{sf}/events.parquet*", schema)
    return stream.withColumn("ts", ltz("ts"))


@query("SELECT event_id, user_id, event_type, ts FROM events")
def stream_file_ingest(spark, sf):
    stream = _events(spark, sf).select("event_id", "user_id", "event_type", "ts")
    stored = streams.ingest(stream, fresh_dir(spark, "ingest"), fresh_dir(spark, "ingest-log"))
    return stored.withColumn("ts", stored["ts"].cast("timestamp_ntz"))


@query("SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS interval_start, count(*) AS n_events FROM events GROUP BY 1")
def stream_quarter_hour(spark, sf):
    counts = streams.quarter_hour_counts(_events(spark, sf).select("ts"), "ts", "1 day")
    out, log = fresh_dir(spark, "quarters"), fresh_dir(spark, "quarters-log")
    newest = streams.upsert(counts, ["interval_start"], ["n_events"], out, log)
    return newest.withColumn("interval_start", newest["interval_start"].cast("timestamp_ntz"))


@query("SELECT event_id, user_id, ts FROM events")
def stream_dedup(spark, sf):
    stream = _events(spark, sf).select("event_id", "user_id", "ts")
    twice = stream.union(stream)
    once = streams.deduplicated(twice, ["event_id", "user_id"], "ts", "1 day")
    stored = streams.ingest(once, fresh_dir(spark, "dedup"), fresh_dir(spark, "dedup-log"))
    return stored.withColumn("ts", stored["ts"].cast("timestamp_ntz"))


@query("SELECT event_id, event_type, ts, CAST(ts AS DATE) AS day FROM events")
def stream_partition_sink(spark, sf):
    stream = _events(spark, sf).select("event_id", "event_type", "ts")
    stored = streams.partition_sink(stream, "ts", fresh_dir(spark, "days"), fresh_dir(spark, "days-log"))
    return stored.withColumn("ts", stored["ts"].cast("timestamp_ntz"))


@query("SELECT event_id, ts, user_id FROM events")
def stream_pages_ingest(spark, sf):
    """A paginated source as a stream, stored by two runs of the same query."""
    events = table(spark, sf, "events").select("event_id", "ts", "user_id")
    out, log = fresh_dir(spark, "page-stream"), fresh_dir(spark, "page-stream-log")
    for _ in range(2):
        pages = stream_pages(spark, ParquetPages(f"{sf}/events.parquet", events.columns), events.schema, page_size=1000)
        stored = streams.ingest(pages, out, log)
    return stored


def _landing(spark, parts, name: str) -> str:
    """A landing folder where the parts arrive one after the other."""
    path = fresh_dir(spark, name)
    for part in parts:
        part.write.mode("append").parquet(path)
    return path


@query("SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS interval_start, count(*) AS n_events FROM events GROUP BY 1")
def stream_late_counts(spark, sf):
    """Counts per 15 minutes with their corrections: a part of the rows arrives after all others."""
    events = table(spark, sf, "events").select("event_id", ltz("ts").alias("ts"))
    in_time, behind = events.where("event_id % 19 <> 0"), events.where("event_id % 19 = 0")
    middle = F.lit("2024-01-15").cast("timestamp")
    parts = [in_time.where(F.col("ts") < middle), in_time.where(F.col("ts") >= middle), behind]
    landing = streams.landing_stream(spark, _landing(spark, parts, "rides"), events.schema, files_per_batch=1)
    out, log = fresh_dir(spark, "late"), fresh_dir(spark, "late-log")
    late.store(late.counts_and_corrections(landing, "ts", "1 hour"), out, log)
    totals = late.interval_totals(spark, out, log).select("interval_start", "n_events")
    return totals.withColumn("interval_start", totals["interval_start"].cast("timestamp_ntz"))


@query("""
WITH m AS (SELECT date_trunc('minute', ts) AS t, count(*) AS n FROM events GROUP BY 1)
SELECT a.t AS interval_start, a.n AS n_rows, b.t AS later_start, b.n AS later_rows
FROM m a JOIN m b ON b.t = a.t + INTERVAL 4 HOUR
""")
def stream_offset_join(spark, sf):
    """Each minute's count beside the count four hours later, as a join of two streams of counts."""
    minutes = table(spark, sf, "events").groupBy(F.date_trunc("minute", ltz("ts")).alias("minute")).agg(F.count("*").alias("n"))
    path = fresh_dir(spark, "minutes")
    minutes.sortWithinPartitions("minute").write.parquet(path)
    both = [streams.landing_stream(spark, path, minutes.schema) for _ in range(2)]
    pairs = late.offset_join(*both, "minute", "n", "4 hours", "1 day")
    stored = streams.ingest(pairs, fresh_dir(spark, "pairs"), fresh_dir(spark, "pairs-log"))
    return stored.withColumns({c: stored[c].cast("timestamp_ntz") for c in ("interval_start", "later_start")})
