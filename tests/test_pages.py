"""Bounds that reach a paginated service, and pages as a stream that starts again."""

import datetime as dt
import os
import re
import sys
import uuid

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

from tidemark.operators.filters import in_epoch_interval, in_interval
from tidemark.sources.paginated import ParquetPages, read_pages, stream_pages
from tidemark.streaming import files as streams

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = T.StructType([T.StructField("n", T.LongType()), T.StructField("text", T.StringType())])


class Service:
    """Records 0, 1, 2, ...; every request leaves a file in ``log``. The total is read anew each time."""

    def __init__(self, folder, low=None, high=None):
        self.folder, self.low, self.high = str(folder), low, high

    def total(self):
        with open(f"{self.folder}/total") as file:
            return int(file.read())

    def between(self, column, low, high):
        assert column == "n"
        both = lambda a, b, pick: b if a is None else a if b is None else pick(a, b)
        return Service(self.folder, both(self.low, low, max), both(self.high, high, min))

    def __call__(self, offset, limit):
        with open(f"{self.folder}/log/{uuid.uuid4().hex}", "w") as file:
            file.write(f"{offset} {limit} {self.low} {self.high}")
        rows = range(offset, min(offset + limit, self.total()))
        held = [n for n in rows if (self.low is None or n >= self.low) and (self.high is None or n < self.high)]
        return {"result": [{"n": n, "text": f"r{n}"} for n in held], "total": self.total()}

    def requests(self):
        log = f"{self.folder}/log"
        return sorted(tuple(open(f"{log}/{name}").read().split()) for name in os.listdir(log))


@pytest.fixture()
def service(tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "total").write_text("1000")
    return Service(tmp_path)


def test_bounds_reach_every_request_and_other_filters_stay(spark, service):
    pages = read_pages(spark, service, SCHEMA, page_size=100)
    found = in_interval(pages, "n", 250, 310).where("n % 2 = 0 AND text <> 'r252'")
    assert sorted(r["n"] for r in found.collect()) == [n for n in range(250, 310, 2) if n != 252]
    assert {r[2:] for r in service.requests()} == {("250", "310")}


def test_closed_bounds_are_filtered_by_spark(spark, service):
    pages = read_pages(spark, service, SCHEMA, page_size=100)
    assert pages.where("n > 5 AND n <= 9").count() == 4
    assert {r[2:] for r in service.requests()} == {("None", "None")}


def test_epoch_bounds_are_pushed_too(spark, tmp_path, service):
    (tmp_path / "total").write_text("400")
    pages = read_pages(spark, service, SCHEMA, page_size=200)
    assert in_epoch_interval(pages, "n", "1970-01-01", "1970-01-02").count() == 400
    assert {r[2:] for r in service.requests()} == {("0", "86400")}


def test_row_groups_outside_the_bounds_are_not_read(spark, tmp_path):
    path = str(tmp_path / "rows.parquet")
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i) if i % 10 else None) for i in range(1000)]
    schema = "n long, ts timestamp_ntz"
    df = spark.createDataFrame(rows, schema).orderBy("n").coalesce(1)
    df.write.option("parquet.block.size", 1024).option("parquet.page.size", 256).option("parquet.block.row.count.limit", 100).parquet(path)
    pages = ParquetPages(path, ["n", "ts"])
    low, high = dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 12)
    narrow = pages.between("ts", low, high)
    assert pages.total() == 1000 and narrow.total() <= 1000
    found = in_interval(read_pages(spark, pages, df.schema, page_size=50), "ts", "2024-01-11", "2024-01-12")
    assert sorted(r["n"] for r in found.collect()) == [i for i, t in rows if t and low <= t < high]
    if len(list(pages.parts(1))) > 1:
        assert narrow.total() < 1000
    assert narrow.between("n", 10**6, None).total() == 0


def test_bounds_on_instants_and_an_unselected_column(spark, tmp_path):
    path = str(tmp_path / "rows.parquet")
    spark.range(50).select("id", F.timestamp_seconds(F.col("id") * 3600).alias("ts")).coalesce(1).write.parquet(path)
    pages = ParquetPages(path, ["id"]).between("ts", dt.datetime(1970, 1, 1, 5, tzinfo=dt.timezone.utc), None)
    assert pages(0, 100)["result"].column("id").to_pylist() == list(range(5, 50))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampType())])
    read = read_pages(spark, ParquetPages(path, ["id", "ts"]), schema)
    assert in_interval(read, "ts", "1970-01-01 10:00:00", "1970-01-01 12:00:00").count() == 2


def test_a_restarted_stream_fetches_no_page_twice(spark, tmp_path, service):
    out, log = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    run = lambda: streams.ingest(stream_pages(spark, service, SCHEMA, page_size=100, pages_per_task=3), out, log)
    (tmp_path / "total").write_text("250")
    assert run().count() == 250
    assert run().count() == 250
    (tmp_path / "total").write_text("730")
    assert sorted(r["n"] for r in run().collect()) == list(range(730))
    asked = [(int(offset), int(limit)) for offset, limit, *_ in service.requests()]
    assert len(asked) == len(set(asked))
    covered = [n for offset, limit in asked for n in range(offset, offset + limit)]
    assert sorted(covered) == list(range(730))


def test_an_empty_stream_of_pages(spark, tmp_path, service):
    (tmp_path / "total").write_text("0")
    out, log = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    assert streams.ingest(stream_pages(spark, service, SCHEMA), out, log).count() == 0
    with pytest.raises(ValueError):
        stream_pages(spark, service, SCHEMA, page_size=0)
    assert not [r for r in service.requests() if re.match("[1-9]", r[1])]
