"""JDBC reads. The database does filtering and projection; Spark splits the read by a key range."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_options(
    url: str, query: str | None = None, table: str | None = None, split: tuple[str, object, object, int] | None = None,
    fetch_size: int = 10_000, **extra: str,
) -> dict[str, str]:
    """Reader options. ``split`` is (column, lowest, highest, tasks); without it one task reads everything."""
    if (query is None) == (table is None):
        raise ValueError("give either query or table")
    options = {"url": url, "fetchsize": str(fetch_size), **extra}
    if split is None:
        options["query" if query else "dbtable"] = query or table
        return options
    column, low, high, tasks = split
    # Spark splits a dbtable only, so a query goes in as a derived table.
    options["dbtable"] = f"({query}) AS q" if query else table
    options.update(partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(tasks))
    return options


def read_jdbc(spark: SparkSession, url: str, **kwargs) -> DataFrame:
    """The result of a query, or a table, as a DataFrame."""
    return spark.read.format("jdbc").options(**read_options(url, **kwargs)).load()
