"""Shards along a Hilbert curve over several metadata dimensions.

Each dimension is quantised into 2**bits cells, the cells are ordered by their place on a Hilbert curve, and the ordered
rows are cut into runs. Rows near each other on the curve are near in every dimension, so the files of a shard have
narrow minima and maxima in all of them, and a filter on any dimension skips files.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.numbering import number_rows
from tidemark.session import fresh_dir, materialise

BITS = 6
QUANTILE_ERROR = 0.002


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of the points in the columns of ``cells`` (dimensions x points).

    Follows the published transposed-axes form: undo the excess work from the highest bit down, Gray-encode, interleave.
    """
    axes = cells.astype(np.int64, copy=True)
    dims = len(axes)
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for d in range(dims):
            high = (axes[d] & bit) != 0
            swap = np.where(high, 0, (axes[0] ^ axes[d]) & low)
            axes[0] ^= np.where(high, low, swap)
            axes[d] ^= swap
    for d in range(1, dims):
        axes[d] ^= axes[d - 1]
    flip = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(axes[dims - 1] & (1 << level), (1 << level) - 1, 0)
    axes ^= flip
    index = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            index = (index << 1) | ((axes[d] >> level) & 1)
    return index


def number_cell(df: DataFrame, column: str, bits: int = BITS) -> Column:
    """Cells of about equal row counts; the cuts are at most 2**bits - 1 approximate quantiles. NULL is cell 0."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = sorted(set(df.approxQuantile(column, shares, QUANTILE_ERROR)))
    if not cuts:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda cut: cut <= F.col(column)))


def value_cell(df: DataFrame, column: str, bits: int = BITS) -> Column:
    """Cells in the order of the values as text, spread over the whole range, so that a run of cells is a range of values.

    Up to 2**bits - 1 values have a cell each; more are cut into that many ranges with about equal numbers of distinct
    values, of which only the first ones come to the driver. NULL is cell 0.
    """
    most, value = (1 << bits) - 1, F.col(column).cast("string")
    numbered = materialise(number_rows(df.select(value.alias("v")).where("v IS NOT NULL").distinct(), ["v"], "n"), "values")
    total = numbered.count()
    if not total:
        return F.lit(0)
    group = lambda n: F.floor(n * most / total)
    opens = group(F.col("n") - 1) > group(F.col("n") - 2) if total > most else F.lit(True)
    cuts = sorted((r["v"] for r in numbered.where((F.col("n") == 1) | opens).select("v").collect()), key=str.encode)
    below = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda cut: cut <= value))
    return F.when(value.isNull(), 0).otherwise(1 + F.floor((below - 1) * most / len(cuts)).cast("int"))


def along_curve(df: DataFrame, cells: list[Column], bits: int = BITS, name: str = "curve") -> DataFrame:
    """``df`` with the place of its cells on the Hilbert curve; 63 bits in all at most."""
    if len(cells) * bits > 63:
        raise ValueError("dimensions x bits must not exceed 63")

    @F.pandas_udf("long")
    def place(frame: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index(frame.to_numpy(np.int64).T, bits))

    return df.withColumn(name, place(F.struct(*[c.alias(f"d{i}") for i, c in enumerate(cells)])))


def cut_runs(df: DataFrame, order_by: list[str], shards: int) -> DataFrame:
    """``df`` with ``shard`` and ``slot``: the order cut into runs whose row counts differ by one at most.

    The order is taken by range partitions over all of ``order_by``, so a curve cell that holds a third of the rows is
    spread over many tasks. Its last column should make the order total; rows equal in all of it are interchangeable.
    """
    numbered = number_rows(df, order_by, "_n")
    rows = numbered.count()
    place = F.col("_n") - 1
    exact = F.expr(f"cast((_n - 1) * {shards} div {max(rows, 1)} as int)")
    first = F.expr(f"(shard * {max(rows, 1)}L + {shards - 1}) div {shards}")
    return numbered.withColumn("shard", exact).withColumn("slot", place - first).drop("_n")


def write_shards(df: DataFrame, path: str) -> None:
    """One folder per shard; rows arrive in curve order, so no shuffle is needed and a task writes one or two folders."""
    df.write.option("compression", "zstd").partitionBy("shard").parquet(path)


def hilbert_shards(df: DataFrame, key: str, text: str, values: list[str], shards: int) -> DataFrame:
    """Write ``df`` as ``shards`` Hilbert-ordered shards and return the written rows with ``shard`` and ``slot``.

    Dimensions: every column of ``values`` and the UTF-8 size of the text. Ties on the curve are ordered by key and by
    a hash of the text. A missing text has size 0. An empty table gives no rows. Extra columns are kept; the names
    ``curve``, ``size``, ``shard``, ``slot`` and ``_hash`` are the operator's own and replace columns of that name.
    """
    spark = df.sparkSession
    own = [c for c in ("curve", "size", "shard", "slot", "_hash") if c in df.columns]
    sized = df.drop(*own).withColumn("size", F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1)
    cells = [value_cell(sized, c) for c in values] + [number_cell(sized, "size")]
    placed = along_curve(sized, cells).withColumn("_hash", F.xxhash64(text))
    path = fresh_dir(spark, "shards")
    write_shards(cut_runs(placed, ["curve", key, "_hash"], shards).drop("_hash"), path)
    columns = [c for c in placed.columns if c != "_hash"]
    schema = placed.select(*columns, F.lit(0).cast("long").alias("slot"), F.lit(0).alias("shard")).schema
    return spark.read.schema(schema).parquet(path).select(*columns, "shard", "slot")
