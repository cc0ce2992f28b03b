"""File readers. Every schema is declared by the caller."""

from __future__ import annotations

import fnmatch
import re
import zipfile
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.csv as pa_csv
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Quotes inside a field are doubled, as other CSV tools write and read them; blanks around a value belong to it.
CSV_DIALECT = {
    "header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}

# An empty field is NULL and a quoted empty field is empty text. Where every field is quoted, or an empty field would be a
# blank line, NULL is written as this character from the private-use area instead.
NULL_MARK = "\ue000"


def read_json_array(spark: SparkSession, path, schema, multi_line: bool = True) -> DataFrame:
    """Records of JSON array files; a field that a record lacks is NULL.

    One document over many lines needs ``multi_line`` and is read by one task per file. Arrays of one line each are
    splittable and should be read without it.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def read_nested(spark: SparkSession, path, schema, array: str, multi_line: bool = True) -> DataFrame:
    """One row per element of an array field of JSON documents, the element's fields as columns."""
    documents = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return documents.select(F.explode(array).alias("_item")).select("_item.*")


def read_csv(
    spark: SparkSession, paths, schema, columns: list[str] | None = None, name_glob: str | None = None,
    modified_after: str | None = None, multi_line: bool = False, null_text: str = NULL_MARK,
) -> DataFrame:
    """CSV files with a header that must agree with ``schema``; only ``columns`` are parsed.

    ``paths`` may be a list or hold wildcards; all files become one scan. ``name_glob`` and ``modified_after`` choose
    among the files of a landing folder. Files are split between tasks unless fields may hold line breaks. An empty
    field and one with ``null_text`` are NULL, a quoted empty field is empty text.
    """
    reader = spark.read.schema(schema).options(
        enforceSchema=False, multiLine=multi_line, nullValue=null_text, **CSV_DIALECT
    )
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    df = reader.csv(paths)
    return df.select(*columns) if columns else df


def read_delimited(spark: SparkSession, path, fields: list[tuple[str, str]], malformed: str = "raise") -> DataFrame:
    """Space-delimited text, plain or gzipped (one task per gzip file). Quotes are ordinary characters.

    A line with another number of fields raises, or is left out with ``malformed='drop'``.
    """
    parts = F.split("value", " ")
    complete = F.size(parts) == len(fields)
    lines = spark.read.text(path)
    if malformed == "drop":
        lines = lines.where(complete)
    elif malformed == "raise":
        message = F.concat(F.lit(f"expected {len(fields)} fields: "), F.col("value"))
        parts = F.when(complete, parts).otherwise(F.raise_error(message))
    else:
        raise ValueError("malformed must be 'raise' or 'drop'")
    return lines.select(parts.alias("_p")).select(
        *[F.col("_p")[i].cast(kind).alias(name) for i, (name, kind) in enumerate(fields)]
    )


def path_part(glob: str, n: int) -> Column:
    """What the n-th wildcard of ``glob`` stands for in the path of the row's file, counted from 1."""
    segments = glob.split("/")
    first = next(i for i, s in enumerate(segments) if "*" in s)
    pattern = "/".join("([^/]*)".join(re.escape(piece) for piece in s.split("*")) for s in segments[first:])
    return F.regexp_extract(F.col("_metadata.file_path"), f"/{pattern}$", n)


def date_from_path(pattern: str = r"(\d{4}-\d{2}-\d{2})[^/]*$") -> Column:
    """Date in the file's name or folder, NULL without one."""
    return F.try_to_date(F.regexp_extract(F.col("_metadata.file_path"), pattern, 1), "yyyy-MM-dd")


def read_zip_archives(spark: SparkSession, path, name_glob: str = "*.zip") -> DataFrame:
    """The paths of archives; their content is not read here, so they may have any size."""
    return spark.read.format("binaryFile").option("pathGlobFilter", name_glob).load(path).select("path")


def open_file(uri: str) -> pa.NativeFile:
    """A seekable file on a local disk, HDFS or an object store."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem().open_input_file(uri)
    uri = uri.replace("s3a://", "s3://", 1)
    if uri.startswith("file:"):
        return pafs.LocalFileSystem().open_input_file("/" + unquote(uri.removeprefix("file:").lstrip("/")))
    files, place = pafs.FileSystem.from_uri(uri)
    return files.open_input_file(place)


def zip_csv_rows(archives: DataFrame, schema: T.StructType, member: str = "*.csv", path: str = "path") -> DataFrame:
    """Rows of the CSV members of zipped archives, parallel over archives and block by block within one.

    A task seeks in the archive where it lies and holds one block of one member. Python only unpacks and splits; fields
    arrive as text and Spark casts them. An empty field is NULL. A quoted field may hold line breaks.
    """
    names = schema.fieldNames()
    text = pa.schema([(name, pa.string()) for name in names])

    def unpack(batches):
        parse = pa_csv.ConvertOptions(
            include_columns=names,
            column_types=text,
            null_values=[""],
            strings_can_be_null=True,
            quoted_strings_can_be_null=False,
        )
        quoted_breaks = pa_csv.ParseOptions(newlines_in_values=True)
        for batch in batches:
            for uri in batch.column(path).to_pylist():
                with open_file(uri) as file, zipfile.ZipFile(file) as archive:
                    for name in fnmatch.filter(archive.namelist(), member):
                        with archive.open(name) as handle:
                            yield from pa_csv.open_csv(handle, parse_options=quoted_breaks, convert_options=parse)

    strings = T.StructType([T.StructField(name, T.StringType()) for name in names])
    rows = archives.select(path).mapInArrow(unpack, strings)
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
