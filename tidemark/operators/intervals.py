"""Operators on run intervals: readiness, newest interval, differences, alignment and joins of interval metrics.

All of them aggregate to one row per interval (and source) before they compare intervals.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.filters import in_interval


def expected_grid(sources: DataFrame, source: str, start: str, end: str) -> DataFrame:
    """One row per source and day in [start, end), built by exploding the days beside each source."""
    last = F.date_sub(F.lit(end).cast("date"), 1)
    days = F.sequence(F.lit(start).cast("date"), last, F.expr("interval 1 day"))
    return sources.select(F.col(source).alias("source")).distinct().withColumn("day", F.explode(days))


def readiness(grid: DataFrame, data: DataFrame, markers: DataFrame, source: str, ts: str) -> DataFrame:
    """Per expected source and day: rows of data, and whether both data and a completion marker are there."""

    def per_day(df: DataFrame, output: str) -> DataFrame:
        day = F.col(ts).cast("date").alias("day")
        return df.groupBy(F.col(source).alias("source"), day).agg(F.count("*").alias(output))

    n_rows = F.coalesce("_rows", F.lit(0))
    return (
        grid.join(per_day(data, "_rows"), ["source", "day"], "left")
        .join(per_day(markers, "_markers"), ["source", "day"], "left")
        .select(
            "source",
            "day",
            n_rows.alias("n_rows"),
            ((n_rows > 0) & (F.coalesce("_markers", F.lit(0)) > 0)).alias("ready"),
        )
    )


def missing_runs(grid: DataFrame) -> DataFrame:
    """(source, first_day, last_day, n_days): the longest runs of days in a row that are not ready, per source.

    ``grid`` is that of ``readiness``. A day's distance from its number among the missing days is the same for all days
    of a run. The window sees one row per missing day of a source.
    """
    nth = F.row_number().over(Window.partitionBy("source").orderBy("day"))
    runs = grid.where("NOT ready").withColumn("_run", F.date_sub("day", nth))
    return runs.groupBy("source", "_run").agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("n_days")
    ).drop("_run")


def has_data(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """Per day in [start, end): whether the table has at least one row."""
    last = F.date_sub(F.lit(end).cast("date"), 1)
    grid = df.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), last, F.expr("interval 1 day"))).alias("day")
    )
    present = df.select(F.col(ts).cast("date").alias("day")).distinct().withColumn("_seen", F.lit(True))
    return grid.join(present, "day", "left").select("day", F.coalesce("_seen", F.lit(False)).alias("has_data"))


def latest_day(df: DataFrame, ts: str) -> DataFrame:
    """Rows of the newest day only."""
    newest = df.agg(F.date_trunc("day", F.max(ts)).cast(df.schema[ts].dataType)).scalar()
    return df.where(F.col(ts) >= newest)


def latest_complete_day(df: DataFrame, ts: str, now: str) -> DataFrame:
    """Rows of the newest day whose run is due at ``now``: a day is the latest from just after its end for one day."""
    due = dt.datetime.fromisoformat(now) - dt.timedelta(microseconds=1)
    day = due.date() - dt.timedelta(days=1)
    return in_interval(df, ts, day.isoformat(), due.date().isoformat())


def source_metrics(df: DataFrame, source: str, user: str, value: str, ts: str) -> DataFrame:
    """The shared metrics of all sources in one pass."""
    return df.groupBy(F.col(source).alias("source")).agg(
        F.count("*").alias("n_rows"),
        F.countDistinct(user).alias("n_users"),
        F.avg(value).alias("avg_value"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
    )


def dataset(df: DataFrame, name: str, user: str, value: str, ts: str) -> DataFrame:
    """One dataset in the common shape of all, so that the same steps serve any number of them."""
    return df.select(
        F.lit(name).alias("source"),
        F.col(user).cast("bigint").alias("user"),
        F.col(value).cast("double").alias("value"),
        F.col(ts).alias("ts"),
    )


def daily_counts(df: DataFrame, ts: str, source: str | None = None) -> DataFrame:
    """Rows per day (and source)."""
    keys = [F.col(ts).cast("date").alias("day")]
    if source:
        keys.append(F.col(source).alias("source"))
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"))


def daily_difference(df: DataFrame, ts: str, source: str) -> DataFrame:
    """Rows per source and day, and the change since the source's previous day; the window sees one row per day."""
    previous = F.lag("n_rows").over(Window.partitionBy("source").orderBy("day"))
    return daily_counts(df, ts, source).withColumn("difference", F.col("n_rows") - previous)


def join_daily(left: DataFrame, right: DataFrame, ts: str, left_name: str, right_name: str) -> DataFrame:
    """Rows per day of two datasets side by side, for the days that both have."""
    return daily_counts(left, ts).withColumnRenamed("n_rows", left_name).join(
        daily_counts(right, ts).withColumnRenamed("n_rows", right_name), "day"
    )


def offset_join(df: DataFrame, ts: str, unit: str, offset: Column) -> DataFrame:
    """Each interval beside the interval ``offset`` later, one row per interval on both sides."""
    per_interval = (
        df.where(F.col(ts).isNotNull())
        .groupBy(F.date_trunc(unit, ts).cast(df.schema[ts].dataType).alias("interval_start"))
        .agg(F.count("*").alias("n_rows"))
    )
    later = per_interval.select(
        (F.col("interval_start") - offset).alias("interval_start"),
        F.col("interval_start").alias("later_start"),
        F.col("n_rows").alias("later_rows"),
    )
    return per_interval.join(later, "interval_start")
