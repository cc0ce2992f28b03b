"""Interval and membership filters. Bounds are literals, so they reach the file scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

PERIODS = ("minute", "hour", "day")


def in_interval(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Rows with start <= column < end; a bound that is None is left out."""
    if start is not None:
        df = df.where(F.col(column) >= _as(df, column, start))
    if end is not None:
        df = df.where(F.col(column) < _as(df, column, end))
    return df


def in_epoch_interval(df: DataFrame, column: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The same on epoch seconds, with ``YYYY-MM-DD`` bounds read as UTC. Epoch 0 is a bound like any other."""
    if start is not None:
        df = df.where(F.col(column) >= _epoch(start))
    if end is not None:
        df = df.where(F.col(column) < _epoch(end))
    return df


def between(df: DataFrame, column: str, first, last) -> DataFrame:
    """Closed range: both ends are kept."""
    return df.where(F.col(column).between(_as(df, column, first), _as(df, column, last)))


def in_month(df: DataFrame, column: str, year: int, month: int) -> DataFrame:
    """Rows of one calendar month."""
    first, following = month_bounds(year, month)
    return in_interval(df, column, first, following)


def month_bounds(year: int, month: int) -> tuple[str, str]:
    """First day of the month and of the month after it."""
    first = dt.date(year, month, 1)
    following = (first + dt.timedelta(days=31)).replace(day=1)
    return first.isoformat(), following.isoformat()


def until_day(df: DataFrame, column: str, day: str) -> DataFrame:
    """All rows up to and including ``day``, the cumulative cut-off of a run."""
    return in_interval(df, column, end=(dt.date.fromisoformat(day) + dt.timedelta(days=1)).isoformat())


def until_month(df: DataFrame, year_column: str, month_column: str, year: int, month: int) -> DataFrame:
    """Cut-off on text path parts, compared as text, two-digit months."""
    y, m = F.col(year_column), F.col(month_column)
    return df.where((y < f"{year}") | ((y == f"{year}") & (m <= f"{month:02d}")))


def trailing(df: DataFrame, column: str, amount: int, period: str, now=None) -> DataFrame:
    """Rows of the last ``amount`` periods up to ``now``, both ends kept; ``now`` defaults to the newest row."""
    if period not in PERIODS:
        raise ValueError(f"period must be one of {', '.join(PERIODS)}")
    now = _now(df, column, now)
    back = F.expr(f"interval {int(amount)} {period}")
    return df.where((F.col(column) <= now) & (F.col(column) >= now - back))


def retain(df: DataFrame, column: str, minutes: int = 59, now=None) -> DataFrame:
    """Drop what is older than the retention time."""
    return df.where(F.col(column) > _now(df, column, now) - F.expr(f"interval {int(minutes)} minute"))


def _now(df: DataFrame, column: str, now):
    # A scalar subquery over one pruned column: one partial maximum per task, read from the same plan.
    return df.agg(F.max(column)).scalar() if now is None else _as(df, column, now)


def _as(df: DataFrame, column: str, value):
    return F.lit(value).cast(df.schema[column].dataType)


def _epoch(day: str) -> int:
    return int(dt.datetime.fromisoformat(day).replace(tzinfo=dt.timezone.utc).timestamp())
