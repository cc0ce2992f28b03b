"""Sources and sinks on files of a temporary folder."""

import collections
import csv
import datetime as dt
import glob
import gzip
import json
import os
import uuid
import zipfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F, types as T

from tidemark.operators.tables import union_all
from tidemark.plans.events import backfill_stats
from tidemark.session import fresh_dir, materialise, work_dir
from tidemark.sinks import files as sinks, jdbc as jdbc_sink
from tidemark.sources import files as sources, jdbc as jdbc_source
from tidemark.sources.web import fetch_files
from tidemark.sources.catalog import register_csv
from tidemark.sources.paginated import ParquetPages, page_ranges, read_pages

# Records with what files get wrong: quotes, separators, line breaks, blanks, empty text, NULL and a missing field.
RECORDS = [
    {"code": 'say "so", twice', "place": " Lima ", "remark": "two\nlines"},
    {"code": "", "place": "Oslo", "remark": None},
    {"code": "k-7", "remark": "no place"},
    {"code": None, "place": "\\N", "remark": ""},
]
RECORD_SCHEMA = "code string, place string, remark string"
RECORD_ROWS = [tuple(r.get(c) for c in ("code", "place", "remark")) for r in RECORDS]


def ordered(records):
    return sorted(records, key=lambda r: [(v is None, v) for v in r])


def rows(df):
    return ordered(tuple(r) for r in df.collect())


def test_json_array_over_many_lines_with_a_missing_field(spark, tmp_path):
    (tmp_path / "records.json").write_text(json.dumps(RECORDS, indent=2))
    df = sources.read_json_array(spark, str(tmp_path), RECORD_SCHEMA + ", note string")
    assert rows(df.drop("note")) == ordered(RECORD_ROWS)
    assert df.where("note IS NOT NULL").count() == 0


def test_nested_document(spark, tmp_path):
    (tmp_path / "launches.json").write_text(json.dumps({"count": 2, "results": [{"image": "a/b.jpg"}, {"image": None}]}, indent=1))
    df = sources.read_nested(spark, str(tmp_path), "results array<struct<image: string>>", "results")
    assert [r["image"] for r in df.collect()] == ["a/b.jpg", None]


def test_json_to_csv_keeps_rows_and_fields(spark, tmp_path):
    (tmp_path / "in.json").write_text(json.dumps(RECORDS))
    sinks.json_to_csv(spark, str(tmp_path / "in.json"), RECORD_SCHEMA, str(tmp_path / "out"))
    written = [r for f in glob.glob(f"{tmp_path}/out/*.csv") for r in csv.DictReader(open(f, newline=""))]
    assert sorted(tuple(r.values()) for r in written) == sorted(tuple(v or "" for v in r) for r in RECORD_ROWS)
    assert rows(sources.read_csv(spark, str(tmp_path / "out"), RECORD_SCHEMA, multi_line=True)) == ordered(RECORD_ROWS)


@pytest.mark.parametrize("quote_all", [False, True])
@pytest.mark.parametrize("columns", [["code"], ["code", "place", "remark"]])
def test_csv_keeps_null_and_empty_text_apart(spark, tmp_path, quote_all, columns):
    df = spark.createDataFrame(RECORD_ROWS, RECORD_SCHEMA).select(columns)
    sinks.write_csv(df, str(tmp_path / "o"), quote_all=quote_all)
    assert rows(sources.read_csv(spark, str(tmp_path / "o"), df.schema, multi_line=True)) == rows(df)


def test_registered_table_reads_the_dialect_and_spares_other_tables(spark, tmp_path):
    df = spark.createDataFrame([('a"b,c', " x ", 1), ("", None, 2)], "code string, place string, day int")
    sinks.write_csv(df, str(tmp_path / "o"), partition_by=["day"])
    assert rows(register_csv(spark, "odd_dialect", str(tmp_path / "o"), ["day"])) == rows(df)
    assert rows(register_csv(spark, "odd_dialect", str(tmp_path / "o"), ["day"])) == rows(df)
    with pytest.raises(ValueError, match="another folder"):
        register_csv(spark, "odd_dialect", str(tmp_path))
    spark.sql("DROP TABLE odd_dialect")


@pytest.mark.parametrize("n", [0, 1, 999, 1000, 1001, 25_000])
def test_report_of_any_size_keeps_its_order(spark, tmp_path, n):
    df = spark.range(n).withColumn("text", F.lit('q"')).orderBy(F.desc("id"))
    sinks.write_json_report(df, str(tmp_path / "r"))
    (file,) = glob.glob(f"{tmp_path}/r/part-*")
    assert [r["id"] for r in json.load(open(file))] == list(range(n - 1, -1, -1))


def test_rerun_of_a_range_that_lost_days(spark, tmp_path):
    make = lambda days: spark.createDataFrame([(f"2021-01-0{d} 10:00:00", "u") for d in days], "ts string, user string").select(
        F.col("ts").cast("timestamp_ntz").alias("ts"), "user"
    )
    path = str(tmp_path / "s")
    backfill_stats(make([1, 2, 5, 7]), "ts", "user", "2021-01-01", "2021-01-09", path)
    again = backfill_stats(make([2, 9]), "ts", "user", "2021-01-02", "2021-01-06", path)
    assert [str(r["date"]) for r in again.collect()] == ["2021-01-02"]
    assert sorted(os.listdir(path))[-3:] == ["date=2021-01-01", "date=2021-01-02", "date=2021-01-07"]
    assert backfill_stats(make([9]), "ts", "user", "2021-01-01", "2021-01-08", path).count() == 0
    assert not [d for d in os.listdir(path) if d.startswith("date=")]


def test_export_leaves_no_table_and_no_files(spark, tmp_path):
    sinks.export_query(spark.range(3), "export_leftovers", str(tmp_path / "t"), str(tmp_path / "o"))
    assert not os.path.exists(tmp_path / "t") and not spark.catalog.tableExists("export_leftovers")
    assert sources.read_csv(spark, str(tmp_path / "o"), "id long").count() == 3


def test_csv_header_must_match(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="header does not conform"):
        sources.read_csv(spark, str(tmp_path), "a int, b int").collect()


def test_csv_reads_short_and_long_timestamps(spark, tmp_path):
    (tmp_path / "x.csv").write_text("t,d\n2021-01-01 00:00:00,2021-01-01\n2021-01-01T00:00:00.000001,\n")
    found = rows(sources.read_csv(spark, str(tmp_path), "t timestamp_ntz, d date"))
    assert [r[0].microsecond for r in found] == [0, 1]


def test_csv_null_text(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,NULL\n2,x\n")
    found = sources.read_csv(spark, str(tmp_path), "a int, b string", null_text="NULL")
    assert rows(found.na.drop("any")) == [(2, "x")]


def test_csv_text_survives(spark, tmp_path):
    df = spark.createDataFrame([('say "hi", \\ ok', "x"), (None, "line\nbreak")], "a string, b string")
    sinks.write_csv(df, str(tmp_path / "o"), quote_all=True)
    assert set(sources.read_csv(spark, str(tmp_path / "o"), df.schema, multi_line=True).collect()) == set(df.collect())
    first = open(glob.glob(f"{tmp_path}/o/*.csv")[0]).readline().strip()
    assert first == '"a","b"'


def test_landing_folder_filters(spark, tmp_path):
    for name in ("listing-1.csv", "listing-2.csv", "other.csv"):
        (tmp_path / name).write_text("id,price\n1,2\n")
    schema = "id int, price int"
    assert sources.read_csv(spark, str(tmp_path), schema, name_glob="listing-*.csv").count() == 2
    assert sources.read_csv(spark, str(tmp_path), schema, modified_after="2999-01-01T00:00:00").count() == 0
    paths = [str(tmp_path / "listing-1.csv"), str(tmp_path / "other.csv")]
    assert sources.read_csv(spark, paths, schema, ["price"]).columns == ["price"]


VIEW_FIELDS = [("domain_code", "string"), ("page_title", "string"), ("view_counts", "int"), ("unused", "string")]


def test_gzipped_lines_with_quotes_and_a_short_line(spark, tmp_path):
    with gzip.open(tmp_path / "views.gz", "wt") as f:
        f.write('en Google 5 0\nen "Q" 7 0\nen broken 1\n')
    kept = sources.read_delimited(spark, str(tmp_path), VIEW_FIELDS, malformed="drop")
    assert rows(kept) == [("en", '"Q"', 7, "0"), ("en", "Google", 5, "0")]
    with pytest.raises(Exception, match="expected 4 fields"):
        sources.read_delimited(spark, str(tmp_path), VIEW_FIELDS).collect()
    with pytest.raises(ValueError):
        sources.read_delimited(spark, str(tmp_path), VIEW_FIELDS, malformed="ignore")


def test_path_parts_and_file_dates(spark, tmp_path):
    for year, month in (("2018", "12"), ("2019", "01")):
        folder = tmp_path / year
        folder.mkdir()
        (folder / f"{month}.csv").write_text("id\n1\n")
    df = sources.read_csv(spark, f"{tmp_path}/*/*.csv", "id int").select(
        sources.path_part("*/*.csv", 1).alias("y"), sources.path_part("*/*.csv", 2).alias("m")
    )
    assert rows(df) == [("2018", "12"), ("2019", "01")]
    (tmp_path / "listing-2021-07-04.csv").write_text("id\n1\n")
    (tmp_path / "listing-undated.csv").write_text("id\n2\n")
    dated = sources.read_csv(spark, f"{tmp_path}/listing-*.csv", "id int").withColumn("d", sources.date_from_path())
    assert rows(dated) == [(1, dt.date(2021, 7, 4)), (2, None)]


def test_zip_archives_from_files(spark, tmp_path):
    for i in range(3):
        with zipfile.ZipFile(tmp_path / f"{i}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("set/ratings.csv", f'userId,rating,title\n{i},{i}.5,"a, ""b"""\n{i},,\n')
            z.writestr("set/readme.txt", "nothing")
    schema = T.StructType([T.StructField("userId", T.LongType()), T.StructField("rating", T.DoubleType()), T.StructField("title", T.StringType())])
    found = sources.zip_csv_rows(sources.read_zip_archives(spark, str(tmp_path)), schema, "*/ratings.csv").collect()
    assert len(found) == 6
    assert {(r["userId"], r["rating"], r["title"]) for r in found if r["rating"]} == {(i, i + 0.5, 'a, "b"') for i in range(3)}
    assert all(r["title"] is None for r in found if r["rating"] is None)


@pytest.mark.parametrize("total", [0, 1, 99, 100, 101, 1005])
def test_pages_cover_all_records(spark, total):
    def fetch(offset, limit):
        end = min(offset + limit, total)
        return {"result": [{"id": i, "r": i / 2} for i in range(offset, end)], "total": total}

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("r", T.DoubleType())])
    df = read_pages(spark, fetch, schema, page_size=100, pages_per_task=3)
    assert [r[0] for r in rows(df)] == list(range(total))


def test_page_ranges():
    assert [(p.first, p.end) for p in page_ranges(1005, 100, 4)] == [(0, 400), (400, 800), (800, 1005)]
    assert page_ranges(0, 100, 4) == []
    assert [(p.first, p.end) for p in page_ranges(1005, 100, 1, max_tasks=3)] == [(0, 400), (400, 800), (800, 1005)]


def test_parquet_pages_cross_files_and_row_groups(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 1000, 1, 3).write.option("parquet.block.size", 1024).parquet(path)
    fetch = ParquetPages(path, ["id"])
    assert fetch(0, 1)["total"] == 1000
    seen = [r["id"] for offset in range(0, 1000, 70) for r in fetch(offset, 70)["result"].to_pylist()]
    assert sorted(seen) == list(range(1000))
    assert fetch.total() == 1000
    assert fetch(990, 70)["offset"] == 990 and len(fetch(990, 70)["result"]) == 10


def test_each_row_group_is_decoded_once_and_none_on_the_driver(spark, tmp_path, monkeypatch):
    path, log = str(tmp_path / "t"), tmp_path / "log"
    log.mkdir()
    for k in range(3):
        table = pa.table({"id": list(range(k * 1000, k * 1000 + 1000))})
        os.makedirs(path, exist_ok=True)
        pq.write_table(table, f"{path}/{k}.parquet", row_group_size=230)

    class Logged(ParquetPages):
        def _read(self, group):
            if self._cached[0] != group:
                (log / f"{os.getpid()}-{uuid.uuid4().hex}").write_text(f"{group[0]} {group[1]}")
            return super()._read(group)

    fetch = Logged(path, ["id"])
    df = read_pages(spark, fetch, T.StructType([T.StructField("id", T.LongType())]), page_size=100, pages_per_task=4)
    assert [r[0] for r in rows(df)] == list(range(3000))
    decoded = collections.Counter(f.read_text() for f in log.iterdir())
    assert len(decoded) == 15 and set(decoded.values()) == {1}
    assert not [f for f in log.iterdir() if f.name.startswith(f"{os.getpid()}-")]


def test_small_results_as_one_json_array(spark):
    df = spark.createDataFrame([(1, dt.date(2021, 1, 1))], "id int, d date")
    assert json.loads(sinks.json_array(df)) == [{"id": 1, "d": "2021-01-01"}]
    assert sinks.json_array(df.limit(0)) == "[]"
    assert len(json.loads(sinks.json_array(spark.range(3000)))) == 3000


def test_array_lines_keep_nulls_and_all_digits(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 0.1234567890123456, None, dt.datetime(2021, 1, 1, 0, 0, 0, 1)), (None, None, 'q"\n', None)],
        "i long, d double, s string, t timestamp_ntz",
    )
    sinks.write_array_lines(df, str(tmp_path / "o"))
    back = sources.read_json_array(spark, str(tmp_path / "o"), df.schema, multi_line=False)
    assert set(back.collect()) == set(df.collect())


def test_replacing_a_day_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    d1, d2 = dt.date(2021, 1, 1), dt.date(2021, 1, 2)
    sinks.replace_partitions(spark.createDataFrame([(1, d1), (2, d2)], "v int, day date"), path, "day")
    again = spark.createDataFrame([(9, d2)], "v int, day date")
    for _ in range(2):
        sinks.replace_partitions(again, path, "day")
    assert rows(spark.read.schema("v int, day date").parquet(path)) == [(1, d1), (9, d2)]


def test_a_hot_day_is_split_between_writers(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 400_000, 1, 8).select(F.md5(F.col("id").cast("string")).alias("v"), F.lit("2021-01-01").alias("day"))
    previous = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        sinks.replace_partitions(df, path, "day")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", previous)
    assert len(glob.glob(f"{path}/day=2021-01-01/*.parquet")) > 1
    assert spark.read.parquet(path).count() == 400_000


def test_runs_are_kept_apart(spark, tmp_path):
    path = str(tmp_path / "runs")
    sinks.write_run(spark.range(3), path, "20210101T000000")
    assert sinks.write_run(spark.range(5), path, "20210101T001500").count() == 5
    assert sinks.write_run(spark.range(2), path, "20210101T000000").count() == 2
    assert spark.read.parquet(path).count() == 7


def test_backfill_equals_daily_runs(spark, tmp_path):
    moments = [dt.datetime(2021, 1, d, h) for d in (1, 2, 3) for h in (0, 12)]
    df = spark.createDataFrame([(m, i % 2) for i, m in enumerate(moments)], "ts timestamp_ntz, user int")
    whole = rows(backfill_stats(df, "ts", "user", "2021-01-01", "2021-01-04", str(tmp_path / "a")))
    daily = []
    for day in (1, 2, 3):
        daily += rows(backfill_stats(df, "ts", "user", f"2021-01-0{day}", f"2021-01-0{day + 1}", str(tmp_path / "b")))
    assert whole == sorted(daily)
    assert rows(spark.read.parquet(str(tmp_path / "b")).select("date", "user", "n_events")) == whole


def test_an_interval_without_events_leaves_the_store_alone(spark, tmp_path):
    df = spark.createDataFrame([(dt.datetime(2021, 1, 1), 1)], "ts timestamp_ntz, user int")
    path = str(tmp_path / "t")
    assert backfill_stats(df, "ts", "user", "2020-01-01", "2020-01-02", path).count() == 0
    assert backfill_stats(df, "ts", "user", "2021-01-01", "2021-01-02", path).count() == 1
    assert backfill_stats(df, "ts", "user", "2022-01-01", "2022-01-02", path).count() == 0
    assert spark.read.parquet(path).count() == 1


def test_snapshot_notices_a_difference(spark, tmp_path):
    a = spark.range(10)
    assert sinks.fingerprint(a) == sinks.fingerprint(a.repartition(3).orderBy(F.desc("id")))
    assert sinks.fingerprint(a) != sinks.fingerprint(spark.range(1, 11))
    assert sinks.fingerprint(a) != sinks.fingerprint(union_all(a, spark.range(1)))
    a.write.parquet(str(tmp_path / "a"))
    assert sinks.snapshot(spark, str(tmp_path / "a"), str(tmp_path / "b")).count() == 10


def test_catalog_finds_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_csv(spark.createDataFrame([(1, 1.5, 2020), (2, 2.5, 2021)], "id int, v double, y int"), path, partition_by=["y"])
    df = register_csv(spark, "crawl_test", path, ["y"])
    assert df.schema.simpleString() == "struct<id:int,v:double,y:int>"
    assert rows(df.where("y = 2021")) == [(2, 2.5, 2021)]
    spark.sql("DROP TABLE crawl_test")


def test_export_drops_its_table(spark, tmp_path):
    sinks.export_query(spark.range(4), "export_test", str(tmp_path / "table"), str(tmp_path / "csv"))
    assert not spark.catalog.tableExists("export_test")
    assert sources.read_csv(spark, str(tmp_path / "csv"), "id long").count() == 4


# No database is started here; these check what is handed to Spark's JDBC source.
def test_jdbc_options():
    plain = jdbc_source.read_options("jdbc:x", query="SELECT 1")
    assert plain["query"] == "SELECT 1" and "dbtable" not in plain
    split = jdbc_source.read_options("jdbc:x", query="SELECT id FROM t", split=("id", 0, 900, 9))
    assert split["dbtable"] == "(SELECT id FROM t) AS q"
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "0", "900", "9")
    with pytest.raises(ValueError):
        jdbc_source.read_options("jdbc:x")


def test_jdbc_rows_are_stamped(spark):
    stamped = jdbc_sink.stamped(spark.range(1), "2021-01-01T10:15:00")
    assert stamped.collect()[0]["scrape_time"] == dt.datetime(2021, 1, 1, 10, 15)


def test_fetched_files_and_reported_failures(spark):
    def fetch(url):
        if "down" in url:
            raise ConnectionError("no answer")
        return url.encode()

    urls = ["https://h/a.jpg", "https://h/a.jpg", "h/b.jpg", "https://down/c.jpg", None]
    found = fetch_files(spark.createDataFrame([(u,) for u in urls], "u string"), "u", fetch).collect()
    assert {(r["url"], r["file_name"], r["content"] and bytes(r["content"]), r["problem"]) for r in found} == {
        ("https://h/a.jpg", "a.jpg", b"https://h/a.jpg", None),
        ("h/b.jpg", "b.jpg", None, "invalid URL"),
        ("https://down/c.jpg", "c.jpg", None, "ConnectionError: no answer"),
    }


def test_work_folder_comes_from_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert work_dir(spark) == shared.rstrip("/") if shared else os.path.isdir(work_dir(spark))
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")


def test_no_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://somewhere:7077"

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        work_dir(Session())


def test_materialised_rows_are_fixed(spark):
    df = materialise(spark.range(100).withColumn("r", F.rand()), "fixed")
    assert df.collect() == df.collect()
