"""Pages from a directory of sorted chunks against a sorted list."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import directory, numbering


@pytest.fixture(scope="module")
def rows():
    # A third of the rows has one leading value; some have none, and rows without a value come first.
    return [(None if i % 50 == 0 else 7 if i % 3 else i % 101, i, f"r{i}") for i in range(3000)]


@pytest.fixture(scope="module")
def table(spark, rows):
    df = spark.createDataFrame(rows, "a int, b int, c string").repartition(5)
    return directory.page_directory(df, ["a", "b"], chunks=8)


@pytest.fixture(scope="module")
def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


@pytest.mark.parametrize("offset, limit", [(0, 10), (995, 10), (1500, 700), (2990, 50), (3000, 5), (9999, 1), (10, 0), (0, 5000)])
def test_a_page_is_the_slice_of_the_sorted_table(table, ordered, offset, limit):
    page = table.page(offset, limit)
    assert [tuple(r) for r in page.collect()] == [(*r, 3000) for r in ordered[offset : offset + limit]]
    assert page.columns == ["a", "b", "c", "total"]


def test_page_equals_numbered_page(spark, rows, table):
    df = spark.createDataFrame(rows, "a int, b int, c string")
    assert table.page(1234, 100).collect() == numbering.page(df, ["a", "b"], 1234, 100).collect()


def test_a_deep_page_opens_one_or_two_chunks(table):
    chunks = table.chunks.collect()
    assert len(chunks) >= 4 and sum(c["rows"] for c in chunks) == 3000
    largest = max(c["rows"] for c in chunks)
    for offset in (5, 1000, 2500):
        files = table.rows(offset, 20).inputFiles()
        assert 1 <= len(files) <= 2 and largest > 20
    assert len(table.rows(0, 3000).inputFiles()) == len(chunks)


def test_a_hot_leading_value_is_split(table):
    held = [c for c in table.chunks.collect() if c["first"]["a"] == 7]
    assert len(held) >= 2


@pytest.mark.parametrize("key", [(7, 4), (7, -1), (7, 10**6), (-5, 0), (200, 0), (8, 8), (0, 303)])
def test_pages_from_a_key(table, ordered, key):
    place = sum((r[0] is None) or (r[0], r[1]) < key for r in ordered)
    assert table.offset_of(key) == place
    assert [tuple(r) for r in table.from_key(key, 12).collect()] == ordered[place : place + 12]


def test_empty_table_and_bad_offsets(spark):
    none = directory.page_directory(spark.createDataFrame([], "a int"), ["a"])
    assert none.total() == 0 and none.page(0, 5).collect() == [] and none.offset_of((1,)) == 0
    with pytest.raises(ValueError):
        none.rows(-1, 5)


def test_directory_stays_after_its_source_is_gone(spark, tmp_path):
    given = str(tmp_path / "given")
    spark.range(100).withColumn("x", F.col("id") % 7).write.parquet(given)
    made = directory.page_directory(spark.read.parquet(given), ["x", "id"], str(tmp_path / "pages"))
    again = directory.PageDirectory(spark, str(tmp_path / "pages"), ["x", "id"], made.schema)
    assert [r["id"] for r in again.rows(0, 3).collect()] == [0, 7, 14] and again.schema.names == ["id", "x"]
