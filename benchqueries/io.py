"""Sources and sinks: whole tables written in a format and read back."""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
import pyarrow.csv as pa_csv
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import functions as F

from benchqueries import query, rounded, table
from benchqueries.analytics import LISTING, PAIRS, TOP
from tidemark.operators.filters import in_interval, until_month
from tidemark.plans.listings import top_changes
from tidemark.plans.ratings import average_per_item
from tidemark.session import fresh_dir
from tidemark.sinks import files as sinks
from tidemark.sources import files as sources
from tidemark.sources.catalog import register_csv
from tidemark.sources.crawl import crawl_merged as read_merged
from tidemark.sources.paginated import ParquetPages, read_pages
from tidemark.sources.requests import pages_per_request as pages_of


@query("SELECT * FROM events")
def json_array_scan(spark, sf):
    events, path = table(spark, sf, "events"), fresh_dir(spark, "json-array")
    sinks.write_array_lines(events, path)
    return sources.read_json_array(spark, path, events.schema, multi_line=False)


@query("SELECT page_id, url AS image FROM pages")
def nested_json_scan(spark, sf):
    pages, path = table(spark, sf, "pages"), fresh_dir(spark, "nested-json")
    sinks.write_array_lines(pages.select("page_id", F.col("url").alias("image")), path, wrap="results")
    schema = "results array<struct<page_id: bigint, image: string>>"
    return sources.read_nested(spark, path, schema, "results", multi_line=False)


@query("SELECT o_custkey, o_totalprice, o_orderdate FROM orders")
def csv_scan_projected(spark, sf):
    orders, path = table(spark, sf, "orders"), fresh_dir(spark, "csv")
    sinks.write_csv(orders, path)
    return sources.read_csv(spark, path, orders.schema, ["o_custkey", "o_totalprice", "o_orderdate"])


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def multi_file_union_scan(spark, sf):
    orders, path = table(spark, sf, "orders"), fresh_dir(spark, "multi-file")
    dated = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    sinks.write_csv(dated.withColumn("listing", F.year("o_orderdate")), path, partition_by=["listing"])
    return sources.read_csv(spark, f"{path}/listing=*", dated.schema, name_glob="*.csv")


@query("SELECT lang AS domain_code, source AS page_title, CAST(n_chars AS INTEGER) AS view_counts FROM documents")
def delimited_text_scan(spark, sf):
    path = fresh_dir(spark, "delimited")
    documents = table(spark, sf, "documents")
    lines = documents.select(F.concat_ws(" ", "lang", "source", "n_chars", "doc_id").alias("value"))
    lines.write.option("compression", "gzip").text(path)
    fields = [("domain_code", "string"), ("page_title", "string"), ("view_counts", "int"), ("unused", "string")]
    return sources.read_delimited(spark, path, fields).drop("unused")


def _monthly_files(spark, sf):
    """Orders as CSV files below year and month folders, and the reader of both path parts."""
    orders, path = table(spark, sf, "orders"), fresh_dir(spark, "monthly")
    rows = orders.select("o_orderkey", "o_custkey", "o_totalprice")
    dated = orders.select(
        *rows.columns, F.date_format("o_orderdate", "yyyy").alias("y"), F.date_format("o_orderdate", "MM").alias("m")
    )
    sinks.write_csv(dated, path, partition_by=["y", "m"])
    glob = "y=*/m=*/*.csv"
    return sources.read_csv(spark, f"{path}/{glob}", rows.schema).select(
        "*", sources.path_part(glob, 1).alias("year"), sources.path_part(glob, 2).alias("month")
    )


@query("""
SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y') AS "year", strftime(o_orderdate, '%m') AS "month"
FROM orders
""")
def path_partition_scan(spark, sf):
    return _monthly_files(spark, sf)


@query("""
SELECT o_custkey AS "movieId", round(avg(o_totalprice) + 1.3e-7, 4) AS avg_rating, count(*) AS num_ratings FROM orders
WHERE strftime(o_orderdate, '%Y') < '1998' OR (strftime(o_orderdate, '%Y') = '1998' AND strftime(o_orderdate, '%m') <= '03')
GROUP BY 1
""")
def cumulative_by_path(spark, sf):
    chosen = until_month(_monthly_files(spark, sf), "year", "month", 1998, 3)
    return rounded(average_per_item(chosen, "o_custkey", "o_totalprice"), "avg_rating")


@query("""
SELECT o_orderkey, o_totalprice, CAST(date_trunc('month', o_orderdate) AS DATE) AS download_date FROM orders
""")
def stamp_date_from_path(spark, sf):
    orders, path = table(spark, sf, "orders"), fresh_dir(spark, "stamped")
    rows = orders.select("o_orderkey", "o_totalprice")
    day = F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM-dd").alias("listing")
    sinks.write_csv(orders.select(*rows.columns, day), path, partition_by=["listing"])
    files = sources.read_csv(spark, f"{path}/*", rows.schema, name_glob="*.csv")
    return files.withColumn("download_date", sources.date_from_path(r"listing=(\d{4}-\d{2}-\d{2})/[^/]*$"))


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag || chr(10) || ' "' || l_linestatus || '", x' AS note FROM lineitem
""")
def zip_csv_scan(spark, sf):
    """Zipped CSV with line breaks, quotes and commas inside fields."""
    note = F.concat("l_returnflag", F.lit('\n "'), "l_linestatus", F.lit('", x')).alias("note")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", note)
    path = fresh_dir(spark, "zips")

    def archive(batches):
        files, folder = pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
        files.create_dir(folder)
        for i, batch in enumerate(batches):
            text = io.BytesIO()
            pa_csv.write_csv(batch, text)
            # A task that is repeated writes the same names again.
            name = f"{folder}/{TaskContext.get().partitionId()}-{i}.zip"
            with files.open_output_stream(name) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as z:
                z.writestr("data/rows.csv", text.getbuffer())
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows]})

    rows.mapInArrow(archive, "rows long").agg(F.sum("rows")).collect()
    return sources.zip_csv_rows(sources.read_zip_archives(spark, path), rows.schema, "data/*.csv")


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def paginated_source(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    fetch = ParquetPages(f"{sf}/orders.parquet", orders.columns)
    return read_pages(spark, fetch, orders.schema, page_size=1000, pages_per_task=20)


@query("""
SELECT event_id, ts, user_id, "value" FROM events
WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-08' AND user_id <> 7
""")
def paginated_range(spark, sf):
    """One interval of a paginated source: its bounds reach the service, the other filter stays with Spark."""
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    pages = read_pages(spark, ParquetPages(f"{sf}/events.parquet", events.columns), events.schema, page_size=1000)
    return in_interval(pages, "ts", "2024-01-05", "2024-01-08").where("user_id <> 7")


@query("SELECT o_orderkey, o_totalprice, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders")
def catalog_register(spark, sf):
    path = fresh_dir(spark, "crawled")
    orders = table(spark, sf, "orders")
    rows = orders.select("o_orderkey", "o_totalprice", "o_orderpriority", F.year("o_orderdate").alias("y"))
    sinks.write_csv(rows, path, partition_by=["y"])
    name = "crawled_" + path.rsplit("-", 1)[1]
    return register_csv(spark, name, path, ["y"]).withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@query("""
SELECT o_orderkey,
       CASE WHEN year(o_orderdate) < 1997 THEN floor(o_totalprice) ELSE o_totalprice END AS amount,
       CASE WHEN year(o_orderdate) >= 1997 THEN o_orderstatus END AS status,
       CASE WHEN year(o_orderdate) < 1999 THEN date_trunc('day', o_orderdate)
            ELSE o_orderdate + INTERVAL 90 MINUTE END AS moment
FROM orders
""")
def crawl_merged(spark, sf):
    """Files of three ages: whole amounts and no status first, then fractions, then times for days and another order."""
    orders, path, year = table(spark, sf, "orders"), fresh_dir(spark, "ages"), F.year("o_orderdate")
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date").alias("moment")
    ages = {
        "first": (year < 1997, [key, F.floor("o_totalprice").alias("amount"), day]),
        "second": (year.between(1997, 1998), [key, F.col("o_totalprice").alias("amount"), day, F.col("o_orderstatus").alias("status")]),
        "third": (year >= 1999, [
            F.col("o_orderstatus").alias("status"), (F.col("o_orderdate") + F.expr("interval 90 minutes")).alias("moment"),
            F.col("o_totalprice").alias("amount"), key,
        ]),
    }
    for age, (chosen, columns) in ages.items():
        sinks.write_csv(orders.where(chosen).select(*columns), f"{path}/{age}")
    return read_merged(spark, path)


@query("""
SELECT o_custkey AS request, page, (page - 1) * 3 AS "first", least(3, n - (page - 1) * 3) AS size
FROM (SELECT o_custkey, n, unnest(range(1, (n + 2) // 3 + 1)) AS page
      FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1))
""")
def pages_per_request(spark, sf):
    """The requests that fetch all orders of every customer, three at a time."""
    totals = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return pages_of(totals, "o_custkey", "n", 3)


@query("SELECT *, CAST(ts AS DATE) AS day FROM events")
def partition_replace_load(spark, sf):
    events, landing, out = table(spark, sf, "events"), fresh_dir(spark, "landing"), fresh_dir(spark, "replaced")
    sinks.write_csv(events, landing)
    loaded = sources.read_csv(spark, landing, events.schema).withColumn("day", F.col("ts").cast("date"))
    sinks.replace_partitions(loaded, out, "day")
    # The same day once more: replaced, not doubled, and no other day touched.
    sinks.replace_partitions(loaded.where("day = date'2024-01-07'"), out, "day")
    # A day that an earlier run had stored and that has become empty since goes when its range is loaded again.
    sinks.replace_partitions(loaded.limit(1).withColumn("day", F.lit("2031-05-05").cast("date")), out, "day")
    sinks.replace_partitions(loaded.where("false"), out, "day", "2031-05-01", "2031-06-01")
    return spark.read.schema(loaded.schema).parquet(out)


@query("SELECT * FROM customer")
def csv_roundtrip(spark, sf):
    customers, path = table(spark, sf, "customer"), fresh_dir(spark, "csv")
    sinks.write_csv(customers, path)
    return sources.read_csv(spark, path, customers.schema)


@query("SELECT * FROM part")
def quoted_csv_export(spark, sf):
    parts, path = table(spark, sf, "part"), fresh_dir(spark, "quoted")
    sinks.write_csv(parts, path, quote_all=True)
    return sources.read_csv(spark, path, parts.schema)


@query("SELECT conv_id, turn, role, text FROM conversations")
def json_records(spark, sf):
    turns, path = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text"), fresh_dir(spark, "json")
    sinks.write_json_lines(turns, path)
    return sources.read_json_array(spark, path, turns.schema, multi_line=False)


@query(PAIRS + TOP.format("DESC"))
def json_report(spark, sf):
    path = fresh_dir(spark, "report")
    top = top_changes(table(spark, sf, "orders"), *LISTING)
    sinks.write_json_report(top, path)
    return rounded(sources.read_json_array(spark, path, top.schema), "price_diff_per_day")


@query("SELECT *, '20240131T000000' AS run_ts FROM events")
def parquet_roundtrip(spark, sf):
    return sinks.write_run(table(spark, sf, "events"), fresh_dir(spark, "runs"), "20240131T000000")


@query("SELECT * FROM supplier")
def snapshot_copy(spark, sf):
    return sinks.snapshot(spark, f"{sf}/supplier.parquet", fresh_dir(spark, "snapshot"))


@query("SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1")
def ctas_export(spark, sf):
    spent = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("spent")
    )
    path = fresh_dir(spark, "export")
    sinks.export_query(spent, "export_" + path.rsplit("-", 1)[1], fresh_dir(spark, "export-table"), path)
    return sources.read_csv(spark, path, spent.schema)


@query("SELECT * FROM customer")
def json_to_csv(spark, sf):
    customers, source, target = table(spark, sf, "customer"), fresh_dir(spark, "json"), fresh_dir(spark, "csv")
    sinks.write_json_lines(customers, source)
    sinks.json_to_csv(spark, source, customers.schema, target, multi_line=False)
    return sources.read_csv(spark, target, customers.schema)
