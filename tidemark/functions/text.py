"""String expressions: URLs, path keys, JSON members."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def last_segment(url) -> Column:
    """Text after the last slash, the name a fetched file gets."""
    return F.element_at(F.split(_col(url), "/"), -1)


def has_scheme(url) -> Column:
    """Whether the URL can be requested at all; one without scheme is reported, not fetched."""
    return F.coalesce(_col(url).rlike("^(?i)https?://"), F.lit(False))


def json_member(doc, path: str) -> Column:
    """One member of a JSON string, as text."""
    return F.get_json_object(_col(doc), path)


def hourly_dump_path(ts) -> Column:
    """Relative path of the hourly page-view file that covers ``ts``."""
    ts = _col(ts)
    return F.concat(
        F.date_format(ts, "yyyy/yyyy-MM"),
        F.lit("/pageviews-"),
        F.date_format(ts, "yyyyMMdd-HH"),
        F.lit("0000.gz"),
    )


def monthly_path(ts, prefix: str, suffix: str = ".csv") -> Column:
    """``prefix/2019/03.csv`` style key."""
    return F.concat(F.lit(f"{prefix}/"), F.date_format(_col(ts), "yyyy/MM"), F.lit(suffix))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
