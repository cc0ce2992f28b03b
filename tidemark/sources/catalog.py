"""Catalog registration of a folder of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.files import CSV_DIALECT, NULL_MARK

OPTIONS = {**CSV_DIALECT, "nullValue": NULL_MARK}


def register_csv(spark: SparkSession, name: str, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Crawl a CSV folder: infer its schema, register it as a table with all its partitions, and read the table.

    The table reads the dialect of ``write_csv``. A table of that name is replaced only if it lies in the same folder.
    """
    inferred = spark.read.options(inferSchema=True, **OPTIONS).csv(path)
    table = ".".join(_quoted(part) for part in name.split("."))
    if spark.catalog.tableExists(name):
        described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
        if _plain(described.get("Location", "")) != _plain(path):
            raise ValueError(f"{name} is a table of another folder")
        spark.sql(f"DROP TABLE {table}")
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in inferred.schema.fields)
    partitions = f"PARTITIONED BY ({', '.join(map(_quoted, partition_by))})" if partition_by else ""
    options = ", ".join(f"{key} {_literal(str(value).lower() if value in (True, False) else value)}" for key, value in OPTIONS.items())
    spark.sql(f"CREATE TABLE {table} ({columns}) USING csv OPTIONS ({options}) {partitions} LOCATION {_literal(path)}")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.table(name)


def _plain(path: str) -> str:
    return path.removeprefix("file:").rstrip("/").lstrip("/")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
