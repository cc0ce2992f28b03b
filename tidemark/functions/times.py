"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS = 1_000_000

# The report's names of the days, Sunday is 0.
WEEKDAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]

# Time-of-day bands as (first hour, hour after the last, label), and the label of all other hours.
TIME_BANDS = [
    (8, 11, "8 AM - 11 AM"),
    (11, 16, "11 AM - 4 PM"),
    (16, 19, "4 PM - 7 PM"),
    (19, 22, "7 PM - 10 PM"),
]
OTHER_HOURS = "10 PM - 8 AM"


def micros(ts) -> Column:
    """Microseconds since the epoch; zone-less timestamps are read in the session zone (UTC here)."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def whole_seconds(start, stop) -> Column:
    """Seconds from start to stop, truncated toward zero."""
    return F.call_function("div", micros(stop) - micros(start), F.lit(MICROS))


def weekday_number(ts) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(_col(ts)) - 1


def weekday_name(number) -> Column:
    """Name of a 0-6 weekday number, NULL for anything else."""
    return F.try_element_at(F.array(*[F.lit(n) for n in WEEKDAYS]), (_col(number) + 1).cast("int"))


def time_band(ts) -> Column:
    """The report's band of the hour of ``ts``."""
    hour = F.hour(_col(ts))
    bands = [F.when((hour >= first) & (hour < end), label) for first, end, label in TIME_BANDS]
    return F.coalesce(*bands, F.lit(OTHER_HOURS))


def parsed_time(value) -> Column:
    """A zone-less timestamp from a timestamp, ISO text or an HTTP date such as ``Sun, 06 Nov 1994 08:49:37 GMT``.

    Any other text is NULL. The weekday of an HTTP date says nothing that the date does not.
    """
    text = F.regexp_replace(_col(value).cast("string"), r"^[A-Za-z]{3}, ", "")
    http = F.try_to_timestamp(text, F.lit("dd MMM yyyy HH:mm:ss 'GMT'")).cast("timestamp_ntz")
    return F.coalesce(_col(value).try_cast("timestamp_ntz"), http)


def epoch_date(seconds) -> Column:
    """UTC date of epoch seconds, independent of the session zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(_col(seconds) / 86400).cast("int"))


def shift_years(ts, years: int) -> Column:
    """``ts`` moved by whole years; 29 February becomes 28 February in other years."""
    return _col(ts) + F.make_ym_interval(F.lit(years), F.lit(0))


def quarter_hour(ts) -> Column:
    """Start of the 15-minute interval that contains ``ts``."""
    return F.window(_col(ts), "15 minutes").getField("start")


def compact_key(ts) -> Column:
    """Run key such as 20240131T154500."""
    return F.date_format(_col(ts), "yyyyMMdd'T'HHmmss")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
