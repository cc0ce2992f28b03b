"""Rides per 15 minutes whose late rows become corrections, and pairs of two interval streams.

Both keep state for as long as a watermark says, so the stream may run for ever.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidemark.session import ROCKSDB

QUARTER_MICROS = 900_000_000

# An interval's rows are counted under so many keys, for one interval may hold a large share of all rows.
KEYS_PER_INTERVAL = 16

OUTPUT = "interval_start timestamp, part int, n_events long, is_late boolean"


class CountOrCorrect(StatefulProcessor):
    """Counts an interval until the watermark passes its end, then gives the count out and forgets it.

    Rows of an interval whose end the watermark has passed are given out at once, as a correction. They need no state.
    """

    def init(self, handle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows, timerValues):
        start, part = key
        n = sum(len(batch) for batch in rows)
        end = int(start.timestamp() * 1000) + QUARTER_MICROS // 1000
        if timerValues.getCurrentWatermarkInMs() >= end:
            yield self._row(start, part, n, True)
            return
        before = self.count.get()[0] if self.count.exists() else 0
        self.count.update((before + n,))
        self.handle.registerTimer(end)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.count.exists():
            yield self._row(*key, self.count.get()[0], False)
            self.count.clear()

    def close(self) -> None:
        pass

    @staticmethod
    def _row(start, part: int, n: int, late: bool) -> pd.DataFrame:
        return pd.DataFrame({"interval_start": [start], "part": [part], "n_events": [n], "is_late": [late]})


def counts_and_corrections(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """(interval_start, part, n_events, is_late): every row of the stream is in exactly one count or correction.

    An interval is given out once the newest row is ``delay`` past its end. ``part`` splits an interval by row, so its
    count is a sum. State needs the RocksDB store, which is set on the session here. Rows without a time are left out.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    # The key is computed from a number: Spark would drop late rows itself if the key were the watermarked time.
    start = F.timestamp_micros(micros - F.pmod(micros, F.lit(QUARTER_MICROS)))
    part = F.pmod(F.xxhash64(*stream.columns), F.lit(KEYS_PER_INTERVAL)).cast("int")
    keyed = stream.where(F.col(ts).isNotNull()).withWatermark(ts, delay).select(
        start.alias("interval_start"), part.alias("part")
    )
    return keyed.groupBy("interval_start", "part").transformWithStateInPandas(
        CountOrCorrect(), OUTPUT, "Append", "EventTime"
    )


def store(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Append what has arrived to a Parquet table."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def interval_totals(spark: SparkSession, out: str, checkpoint: str) -> DataFrame:
    """(interval_start, n_events, n_late, is_open) from the table and the state of ``counts_and_corrections``.

    ``n_events`` holds the count and all corrections so far; an interval that is still counted is read from the state.
    """
    given = spark.read.schema(OUTPUT).parquet(out)
    state = spark.read.format("statestore").option("stateVarName", "count").load(checkpoint)
    counting = state.select("key.*", F.col("value.n").alias("n_events"), F.lit(False).alias("is_late"))
    both = given.withColumn("is_open", F.lit(False)).unionByName(counting.withColumn("is_open", F.lit(True)))
    return both.groupBy("interval_start").agg(
        F.sum("n_events").alias("n_events"),
        F.coalesce(F.sum(F.when(F.col("is_late"), F.col("n_events"))), F.lit(0).cast("long")).alias("n_late"),
        F.max("is_open").alias("is_open"),
    )


def offset_join(intervals: DataFrame, others: DataFrame, ts: str, value: str, offset: str, delay: str) -> DataFrame:
    """Rows of one stream beside the rows of the other that lie exactly ``offset`` later: a stream-stream inner join.

    Both streams carry ``ts`` and ``value``. A row waits for its partner until both streams are ``delay`` past it, and is
    forgotten then, so the state is bounded by the rows of that time. A row later than that finds no partner.
    """
    earlier = intervals.select(
        F.col(ts).alias("interval_start"), F.col(value).alias("n_rows"),
        (F.col(ts) + F.expr(f"interval {offset}")).alias("_due"),
    ).withWatermark("_due", delay)
    later = others.select(F.col(ts).alias("later_start"), F.col(value).alias("later_rows")).withWatermark("later_start", delay)
    return earlier.join(later, F.col("_due") == F.col("later_start")).drop("_due")
