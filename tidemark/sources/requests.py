"""Requests of a paginated service as a table function: one set of rows for every input row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, PartitioningColumn, udtf

KEY, TOTAL = "request", "total"


@udtf
class PagesOfRequest:
    """The pages that a request for ``total`` records needs: (request, page, first, size).

    Its table argument has columns ``request`` of any type and ``total``; each request is a partition of its own, so the
    requests of one source spread over all tasks. A total that is NULL or 0 gives no pages.
    """

    @staticmethod
    def analyze(requests: AnalyzeArgument, page_size: AnalyzeArgument) -> AnalyzeResult:
        if not requests.isTable or {KEY, TOTAL} - set(requests.dataType.names):
            raise ValueError(f"the first argument must be a table with {KEY} and {TOTAL}")
        if not page_size.isConstantExpression or page_size.value is None or page_size.value < 1:
            raise ValueError("page_size must be a positive constant")
        schema = T.StructType(
            [
                T.StructField(KEY, requests.dataType[KEY].dataType),
                T.StructField("page", T.LongType()),
                T.StructField("first", T.LongType()),
                T.StructField("size", T.LongType()),
            ]
        )
        return AnalyzeResult(schema=schema, partitionBy=[PartitioningColumn(KEY)])

    def eval(self, row, page_size):
        for first in range(0, row[TOTAL] or 0, page_size):
            yield row[KEY], first // page_size + 1, first, min(page_size, row[TOTAL] - first)


def pages_per_request(requests: DataFrame, request: str, total: str, page_size: int) -> DataFrame:
    """(request, page, first, size): every page of every request. A request that stands in two rows gets two sets."""
    given = requests.select(F.col(request).alias(KEY), F.col(total).cast("long").alias(TOTAL))
    return PagesOfRequest(given.asTable(), F.lit(page_size))
