"""Paginated record source as a Python data source: pages are read in parallel by tasks, once or as a stream."""

from __future__ import annotations

import bisect
import copy
import datetime as dt
import uuid
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, Filter, GreaterThanOrEqual, InputPartition, LessThan,
)
from pyspark.sql.pandas.types import to_arrow_schema

# fetch(offset, limit) -> {"result": records, "total": number of records}; records are dicts or one Arrow table
Fetch = Callable[[int, int], dict]


class PageRange(InputPartition):
    """Consecutive pages that one task reads, and what it fetches them with."""

    def __init__(self, first: int, end: int, fetch: Fetch | None = None):
        self.first = first
        self.end = end
        self.fetch = fetch


def page_ranges(total: int, page_size: int, pages_per_task: int, max_tasks: int = 20_000) -> list[PageRange]:
    """Cover [0, total) with runs of whole pages; the runs grow when there would be more than ``max_tasks``."""
    pages = -(-total // page_size)
    step = page_size * max(pages_per_task, -(-pages // max_tasks))
    return [PageRange(first, min(first + step, total)) for first in range(0, total, step)]


def read_pages(
    spark: SparkSession, fetch: Fetch, schema: T.StructType, page_size: int = 100, pages_per_task: int = 10
) -> DataFrame:
    """All records behind ``fetch``, pulled page by page.

    The driver asks for the total only. A page is a plain read, so a lost task repeats it without side effects.
    ``fetch`` must be picklable; bind interval bounds and credentials into it. A fetch with a method ``total`` tells it
    without a page, and one with a method ``parts`` says how its records are best split between tasks, so that no task
    decodes what another one decodes too.

    A fetch with a method ``between(column, low, high)``, which returns the fetch of the records low <= column < high, gets
    the bounds of the query's filters: with ``filters.in_interval`` no page outside the interval is asked for. Other
    filters stay with Spark. It may leave records out of a page instead of numbering them anew.
    """
    if page_size < 1 or pages_per_task < 1:
        raise ValueError("page_size and pages_per_task must be positive")
    arrow_schema = to_arrow_schema(schema)

    class Reader(DataSourceReader):
        def __init__(self):
            self.fetch = fetch

        def partitions(self):
            if hasattr(self.fetch, "parts"):
                ranges = [PageRange(*part) for part in self.fetch.parts(page_size * pages_per_task)]
            else:
                ranges = page_ranges(total_of(self.fetch), page_size, pages_per_task)
            return ranges or [PageRange(0, 0)]

        def read(self, pages):
            return _records(pages.fetch or self.fetch, pages, page_size, arrow_schema)

    if hasattr(fetch, "between"):
        # Without the setting Spark filters after the read, to the same result.
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
        Reader.pushFilters = _push_bounds

    name = f"pages_{uuid.uuid4().hex}"

    class Pages(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return schema

        def reader(self, schema):
            return Reader()

    spark.dataSource.register(Pages)
    return spark.read.format(name).load()


def stream_pages(
    spark: SparkSession, fetch: Fetch, schema: T.StructType, page_size: int = 100, pages_per_task: int = 10
) -> DataFrame:
    """A stream of the records behind ``fetch``, which must keep their places: new ones are added at the end.

    The offset of the stream is the number of records read, so a query that starts again goes on where its checkpoint
    ends, and fetches no page of an earlier batch. The driver asks for the total only; a batch's pages are read by tasks.
    """
    if page_size < 1 or pages_per_task < 1:
        raise ValueError("page_size and pages_per_task must be positive")
    arrow_schema = to_arrow_schema(schema)

    class Reader(DataSourceStreamReader):
        def initialOffset(self):
            return {"records": 0}

        def latestOffset(self):
            return {"records": total_of(fetch)}

        def partitions(self, start, end):
            first = start["records"]
            ranges = page_ranges(end["records"] - first, page_size, pages_per_task)
            return [PageRange(first + r.first, first + r.end) for r in ranges]

        def read(self, pages):
            return _records(fetch, pages, page_size, arrow_schema)

    name = f"page_stream_{uuid.uuid4().hex}"

    class PageStream(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return schema

        def streamReader(self, schema):
            return Reader()

    spark.dataSource.register(PageStream)
    return spark.readStream.format(name).load()


def total_of(fetch: Fetch) -> int:
    """The number of records behind ``fetch``."""
    return fetch.total() if hasattr(fetch, "total") else fetch(0, 1)["total"]


def _records(fetch: Fetch, pages: PageRange, page_size: int, schema: pa.Schema):
    """The records of a run of pages as Arrow batches."""
    for offset in range(pages.first, pages.end, page_size):
        records = fetch(offset, min(page_size, pages.end - offset))["result"]
        if isinstance(records, pa.Table):
            yield from records.select(schema.names).cast(schema).to_batches()
        else:
            yield pa.RecordBatch.from_pylist(records, schema=schema)


def _push_bounds(reader, filters: list[Filter]):
    """Hand half-open bounds on a column to the reader's fetch, and give all other filters back."""
    for f in filters:
        if isinstance(f, (GreaterThanOrEqual, LessThan)) and len(f.attribute) == 1:
            low, high = (f.value, None) if isinstance(f, GreaterThanOrEqual) else (None, f.value)
            reader.fetch = reader.fetch.between(f.attribute[0], low, high)
        else:
            yield f


def _naive(value):
    """An instant as UTC without a zone, so that bounds and statistics compare; other values as they are."""
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


class ParquetPages:
    """Serves a Parquet table by (offset, limit), reading only the row groups a page touches.

    With bounds, row groups whose statistics lie outside are left out of the count and the pages, and records outside are
    left out of their page.
    """

    def __init__(self, uri: str, columns: list[str]):
        self.uri = uri
        self.columns = columns
        self.bounds = ()  # ((column, low or None, high or None), ...)
        self._groups = None  # [(file, row group, first row, end row)]
        self._cached = (None, None)

    def __getstate__(self):
        return {**self.__dict__, "_cached": (None, None)}

    def __setstate__(self, state):
        self.__dict__.update(state)

    def between(self, column: str, low, high) -> ParquetPages:
        """The pages of the records low <= column < high; a bound may be None."""
        narrow = copy.copy(self)
        narrow.bounds, narrow._groups = (*self.bounds, (column, low, high)), None
        return narrow

    def total(self) -> int:
        """The number of records in the row groups that may lie within the bounds, from the footers."""
        groups = self._layout()
        return groups[-1][3] if groups else 0

    def parts(self, rows: int):
        """(first, end, fetch) of runs of whole row groups with at least ``rows`` records where there are as many.

        Each part fetches with its own groups only, so a task carries no more of the layout than it reads.
        """
        own, parts = [], []
        for group in self._layout():
            own.append(group)
            if group[3] - own[0][2] >= rows:
                parts.append(own)
                own = []
        for groups in [*parts, own] if own else parts:
            part = copy.copy(self)
            part._groups = groups
            yield groups[0][2], groups[-1][3], part

    def __call__(self, offset: int, limit: int) -> dict:
        groups = self._layout()
        total = self.total()
        parts = []
        place = max(0, bisect.bisect_right(groups, offset, key=lambda g: g[2]) - 1)
        while place < len(groups) and groups[place][2] < offset + limit:
            group = groups[place]
            first, end = max(offset, group[2]), min(offset + limit, group[3])
            if first < end:
                parts.append(self._within(self._read(group).slice(first - group[2], end - first)))
            place += 1
        records = pa.concat_tables(parts) if parts else []
        return {"result": records, "offset": offset, "limit": limit, "total": total}

    def _filesystem(self):
        if "://" in self.uri or self.uri.startswith("file:"):
            return pafs.FileSystem.from_uri(self.uri.replace("s3a://", "s3://", 1))
        return pafs.LocalFileSystem(), self.uri

    def _layout(self):
        if self._groups is None:
            fs, path = self._filesystem()
            info = fs.get_file_info(path)
            files = [path]
            if info.type == pafs.FileType.Directory:
                listed = fs.get_file_info(pafs.FileSelector(path))
                files = sorted(f.path for f in listed if f.path.endswith(".parquet"))
            self._groups, row = [], 0
            for file in files:
                meta = pq.read_metadata(file, filesystem=fs)
                for i in range(meta.num_row_groups):
                    size = meta.row_group(i).num_rows
                    if not self._may_hold(meta.row_group(i)):
                        continue
                    self._groups.append((file, i, row, row + size))
                    row += size
        return self._groups

    def _read(self, group):
        if self._cached[0] != group:
            fs, _ = self._filesystem()
            with fs.open_input_file(group[0]) as handle:
                columns = list(dict.fromkeys([*self.columns, *[c for c, _, _ in self.bounds]]))
                table = pq.ParquetFile(handle).read_row_group(group[1], columns=columns)
            self._cached = (group, table)
        return self._cached[1]

    def _may_hold(self, group) -> bool:
        """Whether the statistics of a row group allow for a record within the bounds."""
        columns = {group.column(i).path_in_schema: group.column(i).statistics for i in range(group.num_columns)}
        for column, low, high in self.bounds:
            known = columns.get(column)
            if known is None or not known.has_min_max:
                continue
            least, most = _naive(known.min), _naive(known.max)
            if (low is not None and most < _naive(low)) or (high is not None and least >= _naive(high)):
                return False
        return True

    def _within(self, table: pa.Table) -> pa.Table:
        """The records within the bounds; one without a value is outside."""
        for column, low, high in self.bounds:
            held = table.column(column)
            if low is not None:
                table = table.filter(pc.greater_equal(held, pa.scalar(low, held.type)))
                held = table.column(column)
            if high is not None:
                table = table.filter(pc.less(held, pa.scalar(high, held.type)))
        return table.select(self.columns)
