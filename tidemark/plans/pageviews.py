"""Page-view counts: tracked pages of one dump, and the best hour per page."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


DUMP_COLUMNS = {"domain_column": "domain_code", "page_column": "page_title", "views_column": "view_counts"}


def tracked_views(lines: DataFrame, pages: list[str], domain: str, order: list[str], **columns: str) -> DataFrame:
    """Views of each tracked page: 0 if it is absent, the last line in ``order`` if it is there more than once."""
    names = {**DUMP_COLUMNS, **columns}
    found = _last_views(lines, pages, domain, order, names, [])
    wanted = lines.sparkSession.createDataFrame([(p,) for p in dict.fromkeys(pages)], "pagename string")
    return wanted.join(found, "pagename", "left").select("pagename", _or_zero(lines, names))


def tracked_views_per_interval(
    lines: DataFrame, pages: list[str], domain: str, order: list[str], interval: str, **columns: str
) -> DataFrame:
    """The same for every interval's dump at once, as (pagename, pageviewcount, datetime) rows.

    An interval counts as soon as its dump has any line; each one gets a row for every tracked page.
    """
    names = {**DUMP_COLUMNS, **columns}
    found = _last_views(lines, pages, domain, order, names, [F.col(interval).alias("datetime")])
    dumps = lines.where(F.col(interval).isNotNull()).select(F.col(interval).alias("datetime")).distinct()
    tracked = F.array(*[F.lit(p) for p in dict.fromkeys(pages)])
    grid = dumps.select("datetime", F.explode(tracked).alias("pagename"))
    return grid.join(found, ["datetime", "pagename"], "left").select("pagename", _or_zero(lines, names), "datetime")


def _last_views(lines: DataFrame, pages: list[str], domain: str, order: list[str], names: dict, keys: list):
    place = F.struct(*order, names["views_column"])
    return (
        lines.where((F.col(names["domain_column"]) == domain) & F.col(names["page_column"]).isin(pages))
        .groupBy(*keys, F.col(names["page_column"]).alias("pagename"))
        .agg(F.max_by(names["views_column"], place).alias("found"))
    )


def _or_zero(lines: DataFrame, names: dict):
    zero = F.lit(0).cast(lines.schema[names["views_column"]].dataType)
    return F.coalesce("found", zero).alias("pageviewcount")


def best_hour(counts: DataFrame, page: str, views: str, ts: str) -> DataFrame:
    """Hour of day with the highest average views, per page; the earlier hour wins a tie.

    The window sees the aggregate only, at most 24 rows per page.
    """
    hourly = (
        counts.where(F.col(page).isNotNull())
        .groupBy(F.col(page).alias("pagename"), F.hour(ts).alias("hour"))
        .agg(F.avg(views).alias("average_pageviews"))
    )
    best_first = Window.partitionBy("pagename").orderBy(F.desc_nulls_last("average_pageviews"), "hour")
    return hourly.withColumn("_rn", F.row_number().over(best_first)).where("_rn = 1").drop("_rn")
