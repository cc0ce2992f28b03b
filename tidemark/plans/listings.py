"""Price change of listings between their first and last snapshot.

Joining the snapshots back on (id, first date) and (id, last date) pairs every first-day row of a listing with every
last-day row. A clean snapshot has one row per listing and day, so one pair. Duplicated boundary rows make more, and a
hot id could make more pairs than any cluster can write. The functions below therefore keep the two ends apart
(``price_endpoints``), describe the pairs exactly without listing them (``price_change``), and list only the pairs a
report shows (``top_changes``). Nothing is dropped or sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# Largest changes asked for, up to which the listings that hold them are broadcast.
FINALISTS_TO_BROADCAST = 10_000


def _per_day(listings: DataFrame, id_: str, price: str, date: str) -> DataFrame:
    return listings.select(
        F.col(id_).alias("id"),
        F.col(date).cast("date").alias("date"),
        F.col(price).cast("double").alias("price"),
    ).where("id IS NOT NULL AND date IS NOT NULL")


def price_endpoints(listings: DataFrame, id_: str, price: str, date: str) -> DataFrame:
    """The prices of each listing on its first and on its last day, with the number of rows that carry them.

    The join key is (id, date): the days of a hot id are spread, and exact copies have collapsed before.
    """
    rows = _per_day(listings, id_, price, date)
    ends = (
        rows.groupBy("id")
        .agg(F.min("date").alias("first"), F.max("date").alias("last"))
        .select(
            "id",
            F.explode(
                F.array(
                    F.struct(F.lit("oldest").alias("endpoint"), F.col("first").alias("date")),
                    F.struct(F.lit("latest").alias("endpoint"), F.col("last").alias("date")),
                )
            ).alias("end"),
        )
        .select("id", "end.endpoint", "end.date")
    )
    copies = rows.groupBy("id", "date", "price").agg(F.count("*").alias("n_rows"))
    return ends.join(copies, ["id", "date"]).select("id", "endpoint", "date", "price", "n_rows")


def price_change(listings: DataFrame, id_: str, price: str, date: str) -> DataFrame:
    """Per listing seen on more than one day: number of (first, last) row pairs and the change per day over them.

    With one row per listing and day, n_pairs is 1 and the three figures are the one change. Two aggregations and no
    join: (id, date) first, where partial sums take the weight of a hot id, then one row per day and id.
    """
    days = (
        _per_day(listings, id_, price, date)
        .groupBy("id", "date")
        .agg(
            F.count("*").alias("n"),
            F.count("price").alias("priced"),
            F.sum("price").alias("total"),
            F.min("price").alias("low"),
            F.max("price").alias("high"),
        )
    )
    figures = ["n", "priced", "total", "low", "high"]
    ends = days.groupBy("id").agg(
        F.min("date").alias("download_date_min"),
        F.max("date").alias("download_date_max"),
        *[F.min_by(c, "date").alias(f"old_{c}") for c in figures],
        *[F.max_by(c, "date").alias(f"new_{c}") for c in figures],
    )
    span = F.datediff("download_date_max", "download_date_min")
    # The mean over all pairs is the difference of the two means.
    old_mean = F.try_divide("old_total", "old_priced")
    new_mean = F.try_divide("new_total", "new_priced")
    return ends.where(F.col("download_date_max") != F.col("download_date_min")).select(
        "id",
        "download_date_min",
        "download_date_max",
        (F.col("old_n") * F.col("new_n")).alias("n_pairs"),
        ((F.col("new_low") - F.col("old_high")) / span).alias("min_diff_per_day"),
        ((F.col("new_high") - F.col("old_low")) / span).alias("max_diff_per_day"),
        ((new_mean - old_mean) / span).alias("avg_diff_per_day"),
    )


def top_changes(listings: DataFrame, id_: str, price: str, date: str, n: int = 5, rising: bool = True) -> DataFrame:
    """The n pairs with the largest rise (or fall) per day; id, then the two prices, settle ties; NULLs come last.

    Every listing contributes its own best pair, so the n best pairs belong to the n listings whose best pair is best.
    Only their end prices are fetched, and of these only the n extreme ones per end can take part.
    """
    changes = price_change(listings, id_, price, date)
    best = F.col("max_diff_per_day") if rising else F.col("min_diff_per_day")
    order = best.desc_nulls_last() if rising else best.asc_nulls_last()
    finalists = changes.orderBy(order, "id").limit(n).select("id", "download_date_min", "download_date_max")

    at_first, at_last = F.col("date") == F.col("download_date_min"), F.col("date") == F.col("download_date_max")
    prices = (
        _per_day(listings, id_, price, date)
        .join(F.broadcast(finalists) if n <= FINALISTS_TO_BROADCAST else finalists, "id")  # n rows
        .where(at_first | at_last)
        .groupBy("id", "download_date_min", "download_date_max", at_first.alias("first"), "price")
        .agg(F.count("*").alias("copies"))
    )
    # A rise is largest from a low first price to a high last price. The NULL price of an end is one more row.
    wants_low = F.col("first") if rising else ~F.col("first")
    extreme_first = Window.partitionBy("id", "first", F.col("price").isNull()).orderBy(
        F.when(wants_low, F.col("price")).otherwise(-F.col("price"))
    )
    kept = prices.withColumn("_rank", F.row_number().over(extreme_first)).where(F.col("_rank") <= n)
    entry = F.struct("_rank", "price", "copies")
    ends = kept.groupBy("id", "download_date_min", "download_date_max").agg(  # at most n + 1 entries per list
        F.collect_list(F.when(F.col("first"), entry)).alias("old"),
        F.sort_array(F.collect_list(F.when(~F.col("first"), entry))).alias("new"),
    )
    change = (F.col("new.price") - F.col("old.price")) / F.datediff("download_date_max", "download_date_min")
    # Of one listing i x j pairs are at least as large as the pair of the i-th and the j-th extreme price, itself included.
    before = F.col("old._rank") * F.col("new._rank") - 1
    copies = F.least(F.col("old.copies") * F.col("new.copies"), F.lit(n) - before)
    # So the i-th price meets the first n / i of the other list, and its NULL, which is sorted among them.
    partners = F.slice("new", F.lit(1), F.floor(F.lit(n) / F.col("old._rank")).cast("int") + 1)
    pairs = (
        ends.withColumn("old", F.explode("old"))
        .withColumn("new", F.explode(partners))
        .where(before < n)
        # A pair of prices that occurs several times fills as many places, up to those that are left.
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), copies)))
        .select(
            "id",
            "download_date_min",
            F.col("old.price").alias("oldest_price"),
            "download_date_max",
            F.col("new.price").alias("latest_price"),
            change.alias("price_diff_per_day"),
        )
    )
    diff = F.col("price_diff_per_day")
    return pairs.orderBy(
        diff.desc_nulls_last() if rising else diff.asc_nulls_last(), "id", "oldest_price", "latest_price"
    ).limit(n)
