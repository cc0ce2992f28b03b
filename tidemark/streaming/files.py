"""Periodic jobs as Structured Streaming queries over a landing folder.

``availableNow`` handles what has arrived and stops, so the same query runs on a schedule. Checkpoints and outputs
belong in the shared folder. Event-time columns must be ``timestamp``, not zone-less, for watermarks.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.session import list_children

# Versions of a streamed aggregate are merged into one table after so many batches.
COMPACT_EVERY = 16


def landing_stream(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", name_glob: str | None = None,
    files_per_batch: int | None = None, **options,
) -> DataFrame:
    """New files of a folder, each one read once."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def ingest(stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Append everything that has arrived to a Parquet table; its commit log makes each file count once."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _stored(stream.sparkSession, out, stream.schema)


def quarter_hour_counts(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Rows per 15 minutes; a row later than ``delay`` behind the newest one is not counted any more."""
    return (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, "15 minutes").alias("w"))
        .agg(F.count("*").alias("n_events"))
        .select(F.col("w.start").alias("interval_start"), "n_events")
    )


def deduplicated(stream: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """First delivery of each key; a repeat within ``delay`` is dropped, and so is the key's state after it."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def upsert(aggregate: DataFrame, keys: list[str], values: list[str], out: str, checkpoint: str) -> DataFrame:
    """Run an aggregate in update mode and return the newest version of every group.

    Only groups that changed are written. A batch owns the folder of its number, so a repeated batch overwrites itself.
    After every ``COMPACT_EVERY`` batches the newest versions are written as one table, and older ones are not read again.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/versions/batch={number}")

    query = (
        aggregate.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    spark, schema = aggregate.sparkSession, T.StructType([*aggregate.schema.fields, T.StructField("batch", T.LongType())])
    done = max(_numbers(spark, f"{out}/newest"), default=-1)
    batches = [n for n in _numbers(spark, f"{out}/versions") if n > done]
    versions = _stored(spark, f"{out}/versions", schema).where(F.col("batch") > done)
    if done >= 0:
        versions = versions.unionByName(spark.read.schema(schema).parquet(f"{out}/newest/upto={done}"))
    newest = versions.groupBy(*keys).agg(
        *[F.max_by(v, "batch").alias(v) for v in values], F.max("batch").alias("batch")
    )
    if len(batches) >= COMPACT_EVERY:
        path = f"{out}/newest/upto={max(batches)}"
        newest.write.mode("overwrite").parquet(path)
        newest = spark.read.schema(newest.schema).parquet(path)
    return newest.drop("batch")


def partition_sink(stream: DataFrame, ts: str, out: str, checkpoint: str) -> DataFrame:
    """Store a stream by day.

    Each batch writes its own folder, partitioned by day inside, so it can be repeated and two batches that carry the
    same day never overwrite each other.
    """

    def write(batch: DataFrame, number: int) -> None:
        (
            batch.withColumn("day", F.col(ts).cast("date"))
            .hint("rebalance", "day")
            .write.mode("overwrite")
            .partitionBy("day")
            .parquet(f"{out}/batch={number}")
        )

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    schema = stream.schema.add("batch", "long").add("day", "date")
    return _stored(stream.sparkSession, out, schema).drop("batch")


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """The numbers that the finished folders of a sink are named by."""
    folders = [c for c in list_children(spark, path) if "=" in c]
    return [int(c.partition("=")[2]) for c in folders if "_SUCCESS" in list_children(spark, f"{path}/{c}")]


def _stored(spark: SparkSession, out: str, schema) -> DataFrame:
    """What a sink holds; nothing, as long as no file has ever arrived."""
    try:
        return spark.read.schema(schema).parquet(out)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
