"""Item leaderboards from ratings: the distinct-user form and the cumulative warehouse form."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.filters import until_day

CUMULATIVE_SQL = """
SELECT {item} AS movieId, avg({rating}) AS avg_rating, count(*) AS num_ratings
FROM {ratings}
WHERE {day} < date_add(to_date(:ds), 1)
GROUP BY {item}
ORDER BY avg_rating DESC NULLS LAST, movieId
"""


def score_items(ratings: DataFrame, item: str, user: str, rating: str) -> DataFrame:
    """Mean rating and number of distinct users per item.

    Catalyst first reduces to (item, user), so the rows of a very popular item spread over its users.
    """
    return (
        ratings.where(F.col(item).isNotNull())
        .groupBy(F.col(item).alias("movieId"))
        .agg(F.avg(rating).alias("avg_rating"), F.countDistinct(user).alias("num_ratings"))
    )


def rank_items(ratings: DataFrame, item: str, user: str, rating: str, min_ratings: int = 2) -> DataFrame:
    """Items with strictly more than ``min_ratings`` distinct users, best first.

    The id as the last sort key fixes the order and splits a rating that a large share of the items has.
    """
    scored = score_items(ratings, item, user, rating).where(F.col("num_ratings") > min_ratings)
    return scored.orderBy(F.desc_nulls_last("avg_rating"), F.desc("num_ratings"), "movieId")


def most_popular(ratings: DataFrame, item: str, user: str, rating: str, top_n: int = 5) -> DataFrame:
    """The ``top_n`` best items, the smaller id first among equals."""
    return (
        score_items(ratings, item, user, rating)
        .orderBy(F.desc_nulls_last("avg_rating"), F.desc("num_ratings"), "movieId")
        .limit(top_n)
    )


def cumulative_ranking(ratings: DataFrame, item: str, rating: str, day: str, ds: str) -> DataFrame:
    """Mean and number of all ratings up to and including run date ``ds``, no minimum."""
    return average_per_item(until_day(ratings, day, ds), item, rating)


def average_per_item(ratings: DataFrame, item: str, rating: str) -> DataFrame:
    """AVG and COUNT(*) per item, best first."""
    return (
        ratings.groupBy(F.col(item).alias("movieId"))
        .agg(F.avg(rating).alias("avg_rating"), F.count("*").alias("num_ratings"))
        .orderBy(F.desc_nulls_last("avg_rating"), "movieId")
    )


def cumulative_ranking_sql(ratings: DataFrame, item: str, rating: str, day: str, ds: str) -> DataFrame:
    """The same ranking as SQL text with the run date as a named parameter."""
    spark = ratings.sparkSession
    return spark.sql(
        CUMULATIVE_SQL, args={"ds": ds}, ratings=ratings, item=F.col(item), rating=F.col(rating), day=F.col(day)
    )
