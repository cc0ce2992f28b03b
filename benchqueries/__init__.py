"""The operators wired to the driver's test tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with its SQL if there is one."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Engines add floating-point numbers in different orders, so averages are compared to four digits. The offset keeps
# exact halves, common among averages of amounts in cents, away from the point where the last bit decides the rounding.
DIGITS, OFFSET = 4, 1.3e-7


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Averages in the precision of the comparison; the SQL spells out the same."""
    return df.withColumns({c: F.round(F.col(c) + F.lit(OFFSET), DIGITS) for c in columns})


def ltz(column: str) -> Column:
    """A zone-less timestamp as an instant."""
    return F.col(column).cast("timestamp")
