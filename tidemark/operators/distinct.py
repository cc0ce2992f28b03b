"""Distinct users over any range of days, without the rows: exact bitmaps and bounded sketches, kept per day.

A day's summary is made once and merged at will. Bitmaps count exactly and need dense numbers for the users; sketches
have a fixed size and a stated error. Ranges may overlap: a range is exploded to its days, and a day's summary joins each
range that holds it, so the work grows with days times ranges and not with rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.numbering import number_rows
from tidemark.session import materialise

# A bitmap of Spark holds this many numbers.
BUCKET_BITS = 8 * 4096

# HLL sketches of 2^12 registers: 1.04 / sqrt(2^12) is the standard error of an estimate, 1.6 %.
HLL_LOG_SIZE = 12
HLL_ERROR = 1.04 / 2 ** (HLL_LOG_SIZE / 2)

# KLL sketches with k = 200 give a rank within 1.65 % of all rows with 99 % confidence, for one quantile.
KLL_K = 200
KLL_RANK_ERROR = 0.0165

# Exact counts from rows take about this many rows to a task, whatever the number of rows.
TASK_ROWS = 1 << 19


def user_numbers(df: DataFrame, user: str, known: DataFrame | None = None) -> DataFrame:
    """(user, number): dense numbers from 0 for all users but NULL, written once.

    ``known`` holds the numbers given before. They stay, and new users get the numbers after them, so that bitmaps of
    earlier days can be merged with later ones.
    """
    users = df.where(F.col(user).isNotNull()).select(F.col(user).alias("user")).distinct()
    if known is None:
        return materialise(_numbered(users, 0), "user-numbers")
    following = (known.agg(F.max("number")).first()[0] if not known.isEmpty() else -1) + 1
    fresh = _numbered(users.join(known, "user", "left_anti"), following)
    return materialise(known.select("user", "number").unionByName(fresh), "user-numbers")


def _numbered(users: DataFrame, start: int) -> DataFrame:
    return number_rows(users, ["user"], "_nth").select("user", (F.col("_nth") + (start - 1)).cast("long").alias("number"))


def day_bitmaps(df: DataFrame, keys: list[str], ts: str, user: str, numbers: DataFrame | None = None) -> DataFrame:
    """(keys, day, bucket, users): the users of every key and day as bitmaps of ``BUCKET_BITS`` numbers each.

    ``numbers`` are those of ``user_numbers``. Without them ``user`` must be whole numbers that lie densely already. Rows
    without a day or a user count nowhere. A hot key is reduced in each task before the shuffle.
    """
    rows = df.where(F.col(ts).isNotNull() & F.col(user).isNotNull())
    day = F.col(ts).cast("date").alias("day")
    if numbers is None:
        rows = rows.select(*keys, day, F.col(user).cast("long").alias("number"))
    else:
        once = rows.select(*keys, day, F.col(user).alias("user")).distinct()
        rows = once.join(numbers, "user").select(*keys, "day", "number")
    bucket = F.bitmap_bucket_number("number").alias("bucket")
    return rows.groupBy(*keys, "day", bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users"))


def distinct_in_ranges(bitmaps: DataFrame, keys: list[str], ranges: DataFrame) -> DataFrame:
    """(range, keys, n_users): exact distinct users of every key in each range (range, first, last), both days included.

    A key without a user in a range has no row.
    """
    per_bucket = _in_ranges(bitmaps, ranges).groupBy("range", *keys, "bucket").agg(F.bitmap_or_agg("users").alias("users"))
    return per_bucket.groupBy("range", *keys).agg(F.sum(F.bitmap_count("users")).alias("n_users"))


def exact_in_ranges(df: DataFrame, keys: list[str], ts: str, user: str, ranges: DataFrame) -> DataFrame:
    """(range, keys, n_users): exact distinct users of every key in each range (range, first, last), from the rows.

    Users may be of any type and need no numbers. A user's day counts in the ranges that hold it and end before that
    user's next day, so a user counts once in a range and no row is repeated for the ranges that hold it: tasks hold
    about ``TASK_ROWS`` rows, and ranges meet sums per day and next day. A range is one row of ``ranges``. Rows without a
    day or a user count nowhere, and a key without a user in a range has no row.
    """
    tasks = max(1, math.ceil(df.count() / TASK_ROWS))
    rows = df.where(F.col(ts).isNotNull() & F.col(user).isNotNull())
    rows = rows.select(*keys, F.col(user).alias("_user"), F.col(ts).cast("date").alias("day"))
    once = rows.repartition(tasks, *keys, "_user").distinct()
    following = F.lead("day").over(Window.partitionBy(*keys, "_user").orderBy("day"))
    per_day = once.withColumn("_next", following).groupBy(*keys, "day", "_next").agg(F.count("*").alias("_n"))
    held = _in_ranges(per_day, ranges).join(ranges.select("range", "last"), "range")
    counted = held.where(F.col("_next").isNull() | (F.col("_next") > F.col("last")))
    return counted.groupBy("range", *keys).agg(F.sum("_n").alias("n_users"))


def day_sketches(df: DataFrame, keys: list[str], ts: str, user: str, value: str) -> DataFrame:
    """(keys, day, n_rows, users, values): an HLL sketch of the users and a KLL sketch of the values per key and day.

    NULL users and NULL values are in no sketch. A day without values has no KLL sketch.
    """
    return (
        df.where(F.col(ts).isNotNull())
        .groupBy(*keys, F.col(ts).cast("date").alias("day"))
        .agg(
            F.count("*").alias("n_rows"),
            F.hll_sketch_agg(user, HLL_LOG_SIZE).alias("users"),
            F.when(F.count(value) > 0, F.kll_sketch_agg_double(F.col(value).cast("double"), KLL_K)).alias("values"),
        )
    )


def sketches_in_ranges(sketches: DataFrame, keys: list[str], ranges: DataFrame, quantiles: list[float]) -> DataFrame:
    """(range, keys, n_rows, n_users, values_at): merged sketches of every key in each range.

    ``n_users`` is within a few times ``HLL_ERROR`` of the truth. ``values_at`` are values of the column whose ranks are
    within ``KLL_RANK_ERROR`` of the quantiles asked for; NULL where the range has no value.
    """
    merged = _in_ranges(sketches, ranges).groupBy("range", *keys).agg(
        F.sum("n_rows").alias("n_rows"),
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("n_users"),
        F.max(F.col("values").isNotNull()).alias("_valued"),
        F.kll_merge_agg_double("values", KLL_K).alias("_values"),
    )
    at = F.array(*[F.kll_sketch_get_quantile_double("_values", F.lit(float(q))) for q in quantiles])
    return merged.withColumn("values_at", F.when(F.col("_valued"), at)).drop("_valued", "_values")


def trailing_ranges(df: DataFrame, ts: str, days: int) -> DataFrame:
    """(range, first, last): for every day with rows the ``days`` days that end with it, named by its date."""
    day = df.where(F.col(ts).isNotNull()).select(F.col(ts).cast("date").alias("last")).distinct()
    return day.select(F.col("last").alias("range"), F.date_sub("last", days - 1).alias("first"), "last")


def days_of(ranges: DataFrame) -> DataFrame:
    """(range, day) of every range (range, first, last). An inverted range has no days."""
    spans: Column = F.when(F.col("first") <= F.col("last"), F.sequence("first", "last"))
    return ranges.select("range", F.explode(spans).alias("day"))


def _in_ranges(summaries: DataFrame, ranges: DataFrame) -> DataFrame:
    """The summaries of a day beside every range that holds the day."""
    return days_of(ranges).join(summaries, "day")
