"""CSV folders whose files have different columns, read as one table of merged types.

A task reads the header of a file. Files with the same header are one group, read and examined as a whole by splittable
scans. The type of a column is an aggregate over all its values: the narrowest of the kinds below that holds every one of
them, so it does not depend on how the values are spread over files.
"""

from __future__ import annotations

import csv
import io

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.sources.files import NULL_MARK, open_file, read_csv

# From narrow to wide; a column that fits none is text. Whole numbers also count as fractions, and days as times.
KINDS = [("boolean", "boolean"), ("bigint", "whole"), ("double", "fraction"), ("date", "day"), ("timestamp_ntz", "time")]

HEADER_BYTES = 1 << 20


def file_headers(spark: SparkSession, path: str, name_glob: str = "*.csv") -> DataFrame:
    """(path, columns) of every file below ``path``; a task opens its files and reads up to the end of the header.

    An empty file has no columns.
    """

    def headers(batches):
        for batch in batches:
            paths, columns = batch.column("path").to_pylist(), []
            for uri in paths:
                with open_file(uri) as file:
                    start = file.read(HEADER_BYTES).decode("utf-8-sig", "replace")
                columns.append(next(csv.reader(io.StringIO(start, newline="")), []))
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(columns, pa.list_(pa.string()))], names=["path", "columns"]
            )

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", name_glob)
    return files.load(path).select("path").mapInArrow(headers, "path string, columns array<string>")


def crawl_merged(spark: SparkSession, path: str, name_glob: str = "*.csv", multi_line: bool = False) -> DataFrame:
    """All rows of the CSV files below ``path``; a column that a file lacks is NULL there.

    The types come from the values: a column with whole numbers in some files and fractions in others holds fractions,
    days and times give times, anything else gives text. A column without values is text. The plan has one scan per
    distinct header, in the order of the headers; the files' names and those headers are on the driver, no values are.
    """
    groups = file_headers(spark, path, name_glob).groupBy("columns").agg(F.collect_list("path").alias("paths")).collect()
    groups = sorted((g for g in groups if g["columns"]), key=lambda g: g["columns"])
    if not groups:
        raise ValueError(f"no columns below {path}")
    for group in groups:
        if len({c.lower() for c in group["columns"]}) < len(group["columns"]):
            raise ValueError(f"repeated columns {group['columns']} in {group['paths'][0]}")
    parts = [_as_text(spark, g["columns"], sorted(g["paths"]), multi_line) for g in groups]
    names = list(dict.fromkeys(c for g in groups for c in g["columns"]))
    kinds = merged_kinds(parts)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole.select(*[F.col(_quoted(c)).try_cast(kinds[c]).alias(c) for c in names])


def merged_kinds(parts: list[DataFrame]) -> dict[str, str]:
    """The type of every column of tables of text: one aggregation per table, and one over their counts."""
    counts = [_counts(part) for part in parts]
    every = counts[0]
    for more in counts[1:]:
        every = every.unionByName(more)
    sums = [F.sum(name).alias(name) for name in ("n", *[name for _, name in KINDS])]
    narrowest = F.coalesce(*[F.when((F.col("n") > 0) & (F.col(name) == F.col("n")), kind) for kind, name in KINDS], F.lit("string"))
    return {r["column"]: r["kind"] for r in every.groupBy("column").agg(*sums).select("column", narrowest.alias("kind")).collect()}


def _counts(table: DataFrame) -> DataFrame:
    """(column, n, and how many values are of each kind) of one table, in one pass."""
    names = table.columns
    aggregates = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(F.col(_quoted(c))).alias("n"),
            *[F.count(F.when(test, 1)).alias(name) for name, test in _tests(F.col(_quoted(c))).items()],
        )
        for c in names
    ]
    return table.agg(F.array(*aggregates).alias("all")).select(F.explode("all").alias("one")).select("one.*")


def _tests(value: Column) -> dict[str, Column]:
    """Whether a text is of a kind: written as one and with a value of it."""
    number = value.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    day = value.rlike(r"^\d{4}-\d{2}-\d{2}$") & value.try_cast("date").isNotNull()
    time = value.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?$") & value.try_cast("timestamp_ntz").isNotNull()
    return {
        "boolean": F.lower(value).isin("true", "false"),
        "whole": value.rlike(r"^[+-]?\d+$") & value.try_cast("bigint").isNotNull(),
        "fraction": number,
        "day": day,
        "time": day | time,
    }


def _as_text(spark: SparkSession, columns: list[str], paths: list[str], multi_line: bool) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return read_csv(spark, paths, schema, multi_line=multi_line, null_text=NULL_MARK)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
