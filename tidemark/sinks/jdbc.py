"""JDBC sink: rows of one run, stamped with the run time, inserted in batches per task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from tidemark.sources.jdbc import read_jdbc


def stamped(df: DataFrame, run_ts: str, column: str = "scrape_time") -> DataFrame:
    """Add the run time as a constant column."""
    return df.withColumn(column, F.lit(run_ts).cast("timestamp_ntz"))


def append_run(
    df: DataFrame, url: str, table: str, run_ts: str, column: str = "scrape_time", batch_size: int = 10_000,
    connections: int = 32, **extra: str,
) -> int:
    """Append one run and return its number of stored rows; raises if they are not the rows that were written.

    A run that the table already holds is refused before anything is inserted: its rows must be deleted first. A task
    commits its rows in one transaction, but a task that is lost after its commit is repeated; the count afterwards
    shows that.
    """
    spark, run = df.sparkSession, F.col(column) == F.lit(run_ts).cast("timestamp_ntz")
    if not read_jdbc(spark, url, table=table, **extra).where(run).isEmpty():
        raise RuntimeError(f"{table} already holds run {run_ts}; delete its rows first")
    written = Observation()
    # Spread before the write, so that the number of connections does not limit the work before it.
    rows = stamped(df, run_ts, column).repartition(connections).observe(written, F.count(F.lit(1)).alias("rows"))
    rows.write.format("jdbc").mode("append").options(
        url=url, dbtable=table, batchsize=str(batch_size), isolationLevel="READ_COMMITTED", **extra
    ).save()
    stored = read_jdbc(spark, url, table=table, **extra).where(run).count()
    expected = written.get["rows"]
    if stored != expected:
        raise RuntimeError(f"{table} holds {stored} rows of run {run_ts}, expected {expected}")
    return stored
