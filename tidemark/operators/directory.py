"""Deep pages of an ordered table from a page directory.

The table is sorted and written once, in chunks of a total order, with a directory of one row per chunk: its number, its
smallest key, the rows before it and its own rows. A page then reads the directory and the one or two chunks that hold it,
however deep it lies, and a page can also start at a key instead of an offset.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tidemark.session import fresh_dir

CHUNK, POSITION = "_chunk", "_position"
_POSITION_BITS = 33  # monotonically_increasing_id() keeps the row's position in its partition in the low 33 bits


@dataclass
class PageDirectory:
    """A sorted copy of a table at ``path``, whose rows can be read by their place in the order."""

    spark: SparkSession
    path: str
    order_by: list[str]
    schema: T.StructType

    @property
    def chunks(self) -> DataFrame:
        """(chunk, first, before, rows) of every chunk that holds rows."""
        key = T.StructType([self.schema[c] for c in self.order_by])
        fields = [T.StructField("chunk", T.LongType()), T.StructField("first", key)]
        fields += [T.StructField(c, T.LongType()) for c in ("before", "rows")]
        return self.spark.read.schema(T.StructType(fields)).parquet(f"{self.path}/directory")

    def total(self) -> int:
        """Rows of the table, from the directory."""
        return self.chunks.agg(F.sum("rows")).first()[0] or 0

    def rows(self, offset: int, limit: int) -> DataFrame:
        """Rows offset+1 .. offset+limit of the order, sorted; only the chunks that hold them are opened."""
        if offset < 0 or limit < 0:
            raise ValueError("offset and limit must not be negative")
        last = offset + limit
        # As many rows as a page spans chunks: no more than the page has rows.
        held = self.chunks.where((F.col("before") < last) & (F.col("before") + F.col("rows") > offset)).collect()
        parts = [
            self._chunk(c["chunk"], max(offset - c["before"], 0), min(last - c["before"], c["rows"]))
            for c in sorted(held, key=lambda c: c["before"])
            if limit
        ]
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        page = parts[0]
        for part in parts[1:]:
            page = page.unionByName(part)
        return page.orderBy(CHUNK, POSITION).select(*self.schema.names)

    def page(self, offset: int, limit: int) -> DataFrame:
        """The same with the size of the whole table as ``total`` beside each row."""
        return self.rows(offset, limit).withColumn("total", F.lit(self.total()).cast("long"))

    def offset_of(self, key: tuple) -> int:
        """How many rows come before ``key`` in the order, from the directory and one chunk."""
        fields = T.StructType([self.schema[c] for c in self.order_by])
        wanted = self.spark.createDataFrame([tuple(key)], fields).select(F.struct(*self.order_by).alias("_key"))
        # The last chunk that starts before the key; one row, by a tree of maxima over the directory.
        start = self.chunks.join(F.broadcast(wanted), F.col("first") < F.col("_key")).agg(
            F.max(F.struct("before", "chunk", "rows")).alias("c")
        ).first()["c"]
        if start is None:
            return 0
        chunk = self._chunk(start["chunk"], 0, start["rows"])
        inside = chunk.join(F.broadcast(wanted), F.struct(*self.order_by) < F.col("_key")).count()
        return start["before"] + inside

    def from_key(self, key: tuple, limit: int) -> DataFrame:
        """``limit`` rows of the order from ``key`` on, whether or not a row has exactly that key."""
        return self.rows(self.offset_of(key), limit)

    def _chunk(self, number: int, first: int, end: int) -> DataFrame:
        held = self.spark.read.schema(_with(self.schema, POSITION))
        rows = held.parquet(f"{self.path}/rows/{CHUNK}={number}").withColumn(CHUNK, F.lit(number))
        return rows.where((F.col(POSITION) >= first) & (F.col(POSITION) < end))


def page_directory(
    df: DataFrame, order_by: list[str], path: str | None = None, chunks: int | None = None
) -> PageDirectory:
    """Sort ``df`` by ``order_by``, whose last column must make the order total, and write it with its directory.

    Chunks come from range partitions over the whole key, so a leading value that a large share of the rows has is split.
    Their number follows from the size of the table unless ``chunks`` states it.
    Positions in a chunk are written with the rows and are sorted in the files, so a page skips the row groups before it.
    """
    spark = df.sparkSession
    path = path or fresh_dir(spark, "pages")
    ranged = df.repartitionByRange(*([chunks] if chunks else []), *order_by).sortWithinPartitions(*order_by)
    place = F.monotonically_increasing_id()
    placed = ranged.withColumn(CHUNK, F.shiftright(place, _POSITION_BITS)).withColumn(
        POSITION, place.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    )
    placed.write.partitionBy(CHUNK).option("compression", "zstd").parquet(f"{path}/rows")
    written = spark.read.schema(_with(df.schema, POSITION, CHUNK)).parquet(f"{path}/rows")
    first = F.min(F.when(F.col(POSITION) == 0, F.struct(*order_by))).alias("first")
    sizes = written.groupBy(F.col(CHUNK).alias("chunk")).agg(first, F.count("*").alias("rows"))
    # One row per chunk, so this window is bounded by the number of partitions.
    before = F.sum("rows").over(Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    directory = sizes.select("chunk", "first", F.coalesce(before, F.lit(0).cast("long")).alias("before"), "rows")
    directory.coalesce(1).write.parquet(f"{path}/directory")
    return PageDirectory(spark, path, order_by, df.schema)


def _with(schema: T.StructType, *numbers: str) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(n, T.LongType()) for n in numbers]])
