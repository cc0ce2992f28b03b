"""File sinks and interval replacement."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.session import fresh_dir, list_children, remove_path
from tidemark.sources.files import CSV_DIALECT, NULL_MARK, read_json_array

# Spark's own default stops at milliseconds; its readers accept any number of digits.
TIMESTAMP_TEXT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_csv(df: DataFrame, path: str, quote_all: bool = False, partition_by: list[str] | None = None) -> None:
    """CSV with a header, every field quoted on request. NULL and empty text stay apart, see ``NULL_MARK``."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    columns = len(df.columns) - len(partition_by or [])
    null_text = NULL_MARK if quote_all or columns == 1 else ""
    options = {"quoteAll": quote_all, "nullValue": null_text, **CSV_DIALECT, **TIMESTAMP_TEXT}
    writer = df.write.mode("overwrite").options(**options)
    writer.partitionBy(*partition_by or []).csv(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    """One JSON record per line, dates in ISO form, NULL fields kept."""
    df.write.mode("overwrite").options(ignoreNullFields=False, **TIMESTAMP_TEXT).json(path)


def json_array(df: DataFrame) -> str:
    """A result that the caller wants as one string: a JSON array of all rows in their order."""
    record = F.to_json(F.struct("*"), {"ignoreNullFields": "false", **TIMESTAMP_TEXT})
    return f"[{','.join(r[0] for r in df.select(record).toLocalIterator())}]"


def write_json_report(df: DataFrame, path: str) -> None:
    """An ordered result of any size as one file that holds one JSON array, a record per line.

    The records are made and written in as many tasks as the result has, in its order. One task then copies their lines
    into the document, batch by batch; nothing passes the driver.
    """

    def lines(batches):
        begin = "["
        for batch in batches:
            if len(batch):
                rows = batch["value"].tolist()
                yield batch.assign(value=[begin + rows[0], *["," + r for r in rows[1:]]])
                begin = ","
        yield pd.DataFrame({"value": ["[]" if begin == "[" else "]"]})

    record = F.to_json(F.struct("*"), {"ignoreNullFields": "false", **TIMESTAMP_TEXT})
    spark, parts = df.sparkSession, fresh_dir(df.sparkSession, "report-lines")
    df.select(record.alias("value")).write.text(parts)
    # Parts are numbered in the order of the result, and one after the other they keep it.
    names = sorted(c for c in list_children(spark, parts) if c.startswith("part-"))
    ordered = [spark.read.schema("value string").text(f"{parts}/{name}") for name in names]
    whole = ordered[0]
    for part in ordered[1:]:
        whole = whole.unionByName(part)
    whole.coalesce(1).mapInPandas(lines, "value string").write.mode("overwrite").text(path)


def write_array_lines(df: DataFrame, path: str, wrap: str | None = None) -> None:
    """JSON arrays of records, one per line and Arrow batch; ``wrap`` puts each array in a field of a document.

    This is how a service hands out records: whole documents, not lines. A batch is bounded, so is a document.
    """

    def pack(batches):
        for batch in batches:
            if len(batch):
                text = f"[{','.join(batch['value'])}]"
                yield batch.iloc[:1].assign(value=f'{{"{wrap}":{text}}}' if wrap else text)

    record = F.to_json(F.struct("*"), {"ignoreNullFields": "false", **TIMESTAMP_TEXT})
    df.select(record.alias("value")).mapInPandas(pack, "value string").write.mode("overwrite").text(path)


def replace_partitions(
    df: DataFrame, path: str, by: str, start: str | None = None, end: str | None = None, values: list[str] | None = None
) -> None:
    """Write ``df``, replacing exactly the partitions of ``path`` that it contains; re-running changes nothing.

    With bounds the whole range start <= ``by`` < end is replaced: its partitions that ``df`` lacks are removed, so an
    interval that has become empty is empty afterwards. With ``values`` that holds for the partitions of these values.
    Values and bounds compare as text, as days in ISO form do.
    Rebalancing gathers a partition's rows into few files and splits a partition that is too large for one task.
    """
    stale = set()
    if start is not None or end is not None or values is not None:
        stored = [c for c in list_children(df.sparkSession, path) if c.startswith(f"{by}=")]
        own = {c: c.partition("=")[2] for c in stored}
        chosen = None if values is None else set(values)
        stale = {c for c, v in own.items() if (start is None or v >= start) and (end is None or v < end)}
        stale = {c for c in stale if chosen is None or own[c] in chosen}
        if stale:
            held = df.select(F.col(by).cast("string")).distinct().where(F.col(by).isin([own[c] for c in stale]))
            stale -= {f"{by}={r[0]}" for r in held.collect()}
    (
        df.hint("rebalance", by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )
    for child in stale:
        remove_path(df.sparkSession, f"{path}/{child}")


def write_run(df: DataFrame, path: str, run_ts: str) -> DataFrame:
    """Store the result of one run under its run key, and return what the path now holds for it."""
    df.write.mode("overwrite").parquet(f"{path}/run_ts={run_ts}")
    schema = T.StructType([*df.schema.fields, T.StructField("run_ts", T.StringType())])
    return df.sparkSession.read.schema(schema).parquet(path).where(F.col("run_ts") == run_ts)


def snapshot(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copy a Parquet table and verify the copy by row count and an order-free hash of all rows."""
    original = spark.read.parquet(source)
    original.write.mode("overwrite").parquet(target)
    copy = spark.read.schema(original.schema).parquet(target)
    if fingerprint(original) != fingerprint(copy):
        raise RuntimeError(f"{target} differs from {source}")
    return copy


def fingerprint(df: DataFrame) -> tuple:
    """(rows, sum of row hashes), equal for equal bags of rows."""
    row_hash = F.xxhash64(*df.columns).cast("decimal(38,0)")
    return tuple(df.agg(F.count("*"), F.sum(row_hash)).first())


def export_query(df: DataFrame, table: str, table_path: str, path: str) -> None:
    """Store a result as a temporary table, export the table as CSV, drop the table and its files."""
    spark = df.sparkSession
    df.write.mode("overwrite").option("path", table_path).format("parquet").saveAsTable(table)
    try:
        write_csv(spark.table(table), path)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        remove_path(spark, table_path)


def json_to_csv(spark: SparkSession, source, schema, target: str, multi_line: bool = True) -> None:
    """Convert JSON records to CSV, the same rows and fields."""
    write_csv(read_json_array(spark, source, schema, multi_line), target)
