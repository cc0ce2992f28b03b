"""Row numbers, pages and samples over a total order, without ever sorting the whole table in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.operators.tables import with_small
from tidemark.session import materialise

# Leading rows up to this many are found by pruning; deeper pages number the rows instead. Spark's group limit, which
# prunes inside each scan task, works below spark.sql.optimizer.windowGroupLimitThreshold, 1000 by default.
TOP_K_ROWS = 999

# Scan tasks hand their leading rows to this many merging tasks, and only those to the last one.
MERGE_TASKS = 256

# One number per file; more files than this are joined by shuffle.
GROUPS_TO_BROADCAST = 200_000

_POSITION_BITS = 33  # monotonically_increasing_id() keeps the row's position in its partition in the low 33 bits


def number_rows(df: DataFrame, order_by: list[str], name: str = "row_number") -> DataFrame:
    """Add a 1-based row number over ``order_by``, whose last column must make the order total.

    Range partitions over the whole key stay even when one leading value holds a large share of the rows. The sorted
    chunks are written once, so that counting them and numbering them sees the same chunks.
    """
    ranged = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    place = F.monotonically_increasing_id()
    chunks = materialise(
        ranged.withColumn("_chunk", F.shiftright(place, _POSITION_BITS)).withColumn(
            "_position", place.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
        ),
        "numbered",
    )
    # One row per chunk, so this window and the broadcast are bounded by the number of partitions.
    sizes = chunks.groupBy("_chunk").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_chunk", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return (
        chunks.join(F.broadcast(offsets), "_chunk")
        .withColumn(name, F.col("_offset") + F.col("_position") + 1)
        .drop("_chunk", "_position", "_offset")
    )


def page(df: DataFrame, order_by: list[str], offset: int, limit: int) -> DataFrame:
    """``limit`` rows from ``offset`` on, with the size of the whole table as ``total`` next to each row."""
    total = df.agg(F.count("*")).scalar()
    return leading(df, order_by, limit, offset).withColumn("total", total)


def leading(df: DataFrame, order_by: list[str], limit: int, offset: int = 0) -> DataFrame:
    """Rows offset+1 .. offset+limit of the order: top-k in a tree while that is small, numbered rows beyond.

    A plain top-k would send the k rows of every scan task to one task, too many for a scan of a million tasks.
    """
    last = offset + limit
    if last > TOP_K_ROWS:
        numbered = number_rows(df, order_by, "_rn")
        return numbered.where((F.col("_rn") > offset) & (F.col("_rn") <= last)).orderBy("_rn").drop("_rn")
    branch = Window.partitionBy("_branch").orderBy(*order_by)
    pruned = (
        df.withColumn("_branch", F.spark_partition_id() % MERGE_TASKS)
        .withColumn("_rank", F.row_number().over(branch))
        .where(F.col("_rank") <= last)
        .drop("_branch", "_rank")
    )
    return pruned.orderBy(*order_by).offset(offset).limit(limit)


def every_nth(
    df: DataFrame, order_by: list[str], n: int, columns: list[str] | None = None, header_lines: int = 1,
    within: str | None = None,
) -> DataFrame:
    """Every n-th line of the ordered table, counting the header as a line, projected; rows with NULLs dropped.

    ``within`` names the column, such as the file, in whose every value the lines are counted anew.
    """
    wanted = columns or df.columns
    order = [within, *order_by] if within else order_by
    numbered = number_rows(df.select(*dict.fromkeys([*wanted, *order])), order, "_line")
    line = F.col("_line")
    if within:
        starts, _ = with_small(numbered.groupBy(within).agg(F.min("_line").alias("_start")), GROUPS_TO_BROADCAST)
        starts = starts.withColumnRenamed(within, "_within")
        numbered = numbered.join(starts, F.col(within).eqNullSafe(F.col("_within"))).drop("_within")
        line = line - F.col("_start") + 1
    return numbered.where((line + header_lines) % n == 0).select(*wanted).na.drop("any")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """Exactly n rows (all, if there are fewer), the same ones for one seed whatever the partitioning.

    The rows with the n smallest hashes. Hashes are uniform, so a bound a little above the n-th smallest is known from
    the row count; if more than n rows lie below it, the sample does too, and only those rows are ordered.
    """
    keyed = df.withColumn("_draw", F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))))
    total = df.count()
    share = (n + 8 * n**0.5 + 16) / max(total, 1)
    if share < 1:
        # Written once, for they are counted and then ordered; they are hardly more than the sample.
        below = materialise(keyed.where(F.col("_draw") <= f"{int(share * 2**32):08x}"), "sample")
        if below.count() >= n:
            keyed = below
    return leading(keyed, ["_draw", key], n).drop("_draw")
