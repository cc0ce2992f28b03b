"""Small relational building blocks shared by the plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def with_small(df: DataFrame, max_rows: int) -> tuple[DataFrame, bool]:
    """``df`` marked for broadcast if a bounded count proves that it has at most ``max_rows`` rows.

    Beyond that it comes back unchanged and the join shuffles, with AQE splitting skewed partitions.
    """
    small = df.limit(max_rows + 1).count() <= max_rows
    return (F.broadcast(df) if small else df), small


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Bag union by column name; a column that one side lacks is NULL there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def deduplicate(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per key, or per full row. Copies collapse before the shuffle, so a hot key moves once per task."""
    return df.dropDuplicates(keys) if keys else df.distinct()


def lookup(df: DataFrame, key: str, names: DataFrame, name_key: str, name_value: str, output: str, default: str):
    """Name of an id from a dimension with unique ids, or the default.

    No hint: Catalyst broadcasts the dimension while it is below autoBroadcastJoinThreshold and sort-merges otherwise.
    """
    dim = names.select(F.col(name_key).alias("_key"), F.col(name_value).alias("_name"))
    return (
        df.join(dim, F.col(key) == F.col("_key"), "left")
        .withColumn(output, F.coalesce("_name", F.lit(default)))
        .drop("_key", "_name")
    )


def cutover(df: DataFrame, column: str, moment, old, new) -> DataFrame:
    """Rows before ``moment`` through ``old``, the others through ``new``, then one table again.

    Every row takes exactly one branch: one without a value is not known to lie before ``moment`` and takes ``new``.
    """
    before = F.col(column) < F.lit(moment).cast(df.schema[column].dataType)
    other = F.col(column).isNull() | ~before
    return union_all(df.where(before).transform(old), df.where(other).transform(new))
