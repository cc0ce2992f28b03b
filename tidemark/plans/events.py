"""Event statistics per day and user, for one interval or a whole backfill."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.filters import in_interval
from tidemark.sinks.files import replace_partitions


def event_stats(events: DataFrame, day: str = "date", user: str = "user") -> DataFrame:
    """Events per (day, user). Rows without a key are left out, as a NULL group is not a user."""
    return (
        events.where(F.col(day).isNotNull() & F.col(user).isNotNull())
        .groupBy(F.col(day).cast("date").alias("date"), F.col(user).alias("user"))
        .agg(F.count("*").alias("n_events"))
    )


def backfill_stats(events: DataFrame, ts: str, user: str, start: str, end: str, path: str) -> DataFrame:
    """Statistics of every interval in [start, end) as one job, replacing the days of the range in ``path``.

    A day of the range without events is no longer stored afterwards; days outside the range stay as they are.
    """
    stats = event_stats(in_interval(events, ts, start, end), ts, user)
    replace_partitions(stats, path, "date", start, end)
    spark = events.sparkSession
    stored = spark.read.schema(stats.schema).parquet(path)
    return in_interval(stored, "date", start, end).select(*stats.columns)


def rerun_missing(events: DataFrame, ts: str, user: str, runs: DataFrame, path: str) -> DataFrame:
    """Statistics of exactly the days in ``runs`` (first_day, last_day), as one job, replacing those days in ``path``.

    Runs may overlap, such as those of several sources. All other days stay as they are and their events are not read
    if the files tell them apart. Returns what is stored for the days.
    """
    days = runs.select(F.explode(F.sequence("first_day", "last_day")).alias("date")).distinct()
    bounds = runs.agg(F.min("first_day").alias("first"), F.date_add(F.max("last_day"), 1).alias("end")).first()
    spark = events.sparkSession
    if bounds["first"] is None:
        return event_stats(events, ts, user).where("false")
    within = in_interval(events, ts, bounds["first"].isoformat(), bounds["end"].isoformat())
    chosen = within.withColumn("_day", F.col(ts).cast("date")).join(days.withColumnRenamed("date", "_day"), "_day", "left_semi")
    stats = event_stats(chosen, ts, user)
    # One text per day that is run again; the folder names to remove are chosen among them.
    replace_partitions(stats, path, "date", values=[r["date"].isoformat() for r in days.collect()])
    stored = spark.read.schema(stats.schema).parquet(path)
    return stored.join(days, "date", "left_semi").select(*stats.columns)
