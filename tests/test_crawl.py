"""Files with different columns, requests as a table function, runs of missing days, and mended rows."""

import datetime as dt
import json
import zipfile

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.operators import intervals, tables
from tidemark.plans import events as event_plans, listings
from tidemark.sinks import files as sinks
from tidemark.sources import crawl, files as sources, requests


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8", newline="")


def test_added_missing_reordered_and_widened_columns(spark, tmp_path):
    folder = tmp_path / "files"
    write(folder, "a.csv", "id,amount,day,flag,note\n1,5,2024-01-01,true,x\n2,,2024-01-02,FALSE,\n")
    write(folder, "b.csv", "id,amount,day,flag,note\n3,7,2024-02-30,,\"a\"\"b, c\"\n")
    write(folder, "c.csv", "amount,id,day,extra,lonely\n2.5,4,2024-01-03T04:05:06,007,\n1e3,5,2024-01-04,12,\n")
    write(folder, "d.csv", "id,flag\n99999999999,true\n")
    write(folder, "empty.csv", "")
    write(folder, "header.csv", "only\n")
    write(folder, "other.txt", "id\nnot,csv\n")
    df = crawl.crawl_merged(spark, str(folder))
    # 30 February is no day, so the column is text; the others are as narrow as all their values allow.
    assert {f.name: f.dataType.simpleString() for f in df.schema} == {
        "id": "bigint", "amount": "double", "day": "string", "flag": "boolean", "note": "string", "extra": "bigint",
        "lonely": "string", "only": "string",
    }
    rows = {r["id"]: r.asDict() for r in df.collect()}
    assert set(rows) == {1, 2, 3, 4, 5, 99999999999}
    assert rows[3]["note"] == 'a"b, c' and rows[2]["note"] is None and rows[2]["flag"] is False
    assert (rows[4]["amount"], rows[5]["amount"], rows[1]["amount"], rows[2]["amount"]) == (2.5, 1000.0, 5.0, None)
    assert rows[4]["extra"] == 7 and rows[1]["extra"] is None and rows[99999999999]["note"] is None


def test_days_and_times_give_times(spark, tmp_path):
    folder = tmp_path / "files"
    write(folder, "a.csv", "t,u\n2024-01-01,2024-01-01\n")
    write(folder, "b.csv", "u,t\n2024-05-05,2024-01-02 03:04:05.25\n")
    df = crawl.crawl_merged(spark, str(folder))
    assert dict(df.dtypes) == {"t": "timestamp_ntz", "u": "date"}
    assert {r["t"] for r in df.collect()} == {dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 3, 4, 5, 250000)}


def test_numbers_beyond_a_long_and_text_like_numbers(spark, tmp_path):
    folder = tmp_path / "files"
    write(folder, "a.csv", "big,mixed,spaced\n99999999999999999999,1, 1\n")
    write(folder, "b.csv", "big,mixed,more\n1,NaN,1\n")
    assert dict(crawl.crawl_merged(spark, str(folder)).dtypes) == {
        "big": "double", "mixed": "string", "spaced": "string", "more": "bigint"
    }


def test_a_column_of_two_kinds_gives_text_in_any_order_of_files(spark, tmp_path):
    for k, order in enumerate(("ab", "ba")):
        folder = tmp_path / f"files{k}"
        for name, value in zip(order, ("true", "3")):
            write(folder, f"{name}.csv", f"v\n{value}\n")
        df = crawl.crawl_merged(spark, str(folder))
        assert dict(df.dtypes) == {"v": "string"} and {r["v"] for r in df.collect()} == {"true", "3"}


def test_nested_folders_line_breaks_and_odd_names(spark, tmp_path):
    write(tmp_path / "files", "a.csv", '"a`b",c.d\n"x\ny",1\n')
    write(tmp_path / "files" / "deeper", "b.csv", "c.d\n2\n")
    df = crawl.crawl_merged(spark, str(tmp_path / "files"), multi_line=True)
    assert df.columns == ["a`b", "c.d"] and sorted(map(tuple, df.collect()), key=str) == [("x\ny", 1), (None, 2)]


def test_nothing_to_crawl_and_repeated_columns(spark, tmp_path):
    write(tmp_path / "none", "a.csv", "")
    with pytest.raises(ValueError, match="no columns"):
        crawl.crawl_merged(spark, str(tmp_path / "none"))
    write(tmp_path / "twice", "a.csv", "x,X\n1,2\n")
    with pytest.raises(ValueError, match="repeated"):
        crawl.crawl_merged(spark, str(tmp_path / "twice"))


def test_every_request_has_its_own_pages(spark):
    rows = [("a", 7), ("b", 0), ("c", None), ("d", 3), (None, 4), ("a", 2)]
    df = spark.createDataFrame(rows, "name string, total int").repartition(3)
    found = requests.pages_per_request(df, "name", "total", 3)
    assert found.schema["request"].dataType == T.StringType()
    expected = [("a", 1, 0, 3), ("a", 2, 3, 3), ("a", 3, 6, 1), ("a", 1, 0, 2), ("d", 1, 0, 3), (None, 1, 0, 3), (None, 2, 3, 1)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    assert requests.pages_per_request(df.where("false"), "name", "total", 3).collect() == []


def test_arguments_of_the_table_function_are_checked(spark):
    df = spark.createDataFrame([(1, 2)], "request int, total int")
    with pytest.raises(Exception, match="positive constant"):
        requests.pages_per_request(df, "request", "total", 0).collect()
    with pytest.raises(Exception, match="must be a table"):
        requests.PagesOfRequest(F.lit(1), F.lit(3)).collect()


def grid(spark, missing):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(12)]
    rows = [(s, d, s is None or d.day not in missing.get(s, ())) for s in missing for d in days]
    return spark.createDataFrame(rows, "source string, day date, ready boolean").repartition(4)


def test_runs_of_missing_days(spark):
    found = intervals.missing_runs(grid(spark, {"a": {1, 2, 3, 7, 12}, "b": set(), "c": set(range(1, 13))}))
    day = lambda n: dt.date(2024, 1, n)
    assert sorted(map(tuple, found.collect())) == [
        ("a", day(1), day(3), 3), ("a", day(7), day(7), 1), ("a", day(12), day(12), 1), ("c", day(1), day(12), 12)
    ]


def test_only_missing_days_are_run_again(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, d, 5), u) for d in range(1, 11) for u in range(d)]
    path, events = str(tmp_path / "stats"), spark.createDataFrame(rows, "ts timestamp_ntz, user int")
    event_plans.backfill_stats(events, "ts", "user", "2024-01-01", "2024-01-11", path)
    # Since then day 3 has lost its events, day 4 has other ones, and day 5 too, but it is not run again.
    changed = events.where("day(ts) NOT IN (3, 4, 5)").unionByName(
        spark.createDataFrame([(dt.datetime(2024, 1, d, 6), 77) for d in (4, 5)], "ts timestamp_ntz, user int")
    )
    runs = spark.createDataFrame([("a", dt.date(2024, 1, 3), dt.date(2024, 1, 4)), ("b", dt.date(2024, 1, 4), dt.date(2024, 1, 4))],
                                 "source string, first_day date, last_day date")
    again = event_plans.rerun_missing(changed, "ts", "user", runs, path)
    assert [(r["date"].day, r["user"], r["n_events"]) for r in again.collect()] == [(4, 77, 1)]
    stored = spark.read.parquet(path).groupBy("date").count().collect()
    assert {r["date"].day: r["count"] for r in stored} == {d: 1 if d == 4 else d for d in range(1, 11) if d != 3}
    assert event_plans.rerun_missing(changed, "ts", "user", runs.where("false"), path).collect() == []


def test_rows_without_a_date_take_one_branch_of_a_cutover(spark):
    df = spark.createDataFrame([(1, dt.datetime(2020, 1, 1)), (2, dt.datetime(2021, 1, 1)), (3, None)], "id int, ts timestamp_ntz")
    mark = lambda name: lambda part: part.withColumn("by", F.lit(name))
    found = tables.cutover(df, "ts", "2021-01-01", mark("old"), mark("new"))
    assert sorted((r["id"], r["by"]) for r in found.collect()) == [(1, "old"), (2, "new"), (3, "new")]


def test_zipped_fields_with_line_breaks_over_many_blocks(spark, tmp_path):
    rows = [(i, f"line {i}\nand \"more\", {'x' * 50}") for i in range(60_000)]
    quoted = lambda t: '"' + t.replace('"', '""') + '"'
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("rows.csv", "id,note\n" + "\n".join(f"{i},{quoted(t)}" for i, t in rows))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType())])
    found = sources.zip_csv_rows(sources.read_zip_archives(spark, str(tmp_path)), schema)
    assert sorted(map(tuple, found.collect())) == rows


def test_a_report_of_many_parts_keeps_its_order(spark, tmp_path):
    df = spark.range(0, 5000).withColumn("key", (F.col("id") * 7919) % 5000).repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_json_report(df.orderBy("key"), str(tmp_path / "report"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = list((tmp_path / "report").glob("part-*"))
    assert len(files) == 1
    assert [r["key"] for r in json.loads(files[0].read_text())] == list(range(5000))
    sinks.write_json_report(df.where("false"), str(tmp_path / "none"))
    assert json.loads(next((tmp_path / "none").glob("part-*")).read_text()) == []


def test_top_changes_list_few_pairs_for_large_n(spark):
    day = [dt.date(2024, 1, 1), dt.date(2024, 1, 31)]
    rows = [(i, float(p), d) for i in range(3) for d in day for p in range(60)] + [(0, None, day[1])]
    df = spark.createDataFrame(rows, "id int, price double, date date")
    top = listings.top_changes(df, "id", "price", "date", n=60)
    pairs = sorted(((b - a) / 30 for i in range(3) for a in range(60) for b in range(60)), reverse=True)[:60]
    assert [r["price_diff_per_day"] for r in top.collect()] == pytest.approx(pairs)
