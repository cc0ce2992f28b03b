"""Fetching the files that a column of URLs names."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.functions.text import has_scheme, last_segment

RESULT = "url string, file_name string, content binary, problem string"


def fetch_files(df: DataFrame, url: str, fetch: Callable[[str], bytes], requests_at_once: int = 64) -> DataFrame:
    """(url, file_name, content, problem) per distinct URL. A URL that cannot be fetched is reported, not fatal.

    ``fetch`` runs inside tasks and must be picklable. Copies of one URL are requested once, and the URLs are spread
    evenly over ``requests_at_once`` tasks.
    """

    def pull(batches):
        for batch in batches:
            for row in batch.to_pylist():
                content, problem = None, None
                if not row.pop("valid"):
                    problem = "invalid URL"
                else:
                    try:
                        content = fetch(row["url"])
                    except Exception as error:  # noqa: BLE001  whatever the client raises is the row's result
                        problem = f"{type(error).__name__}: {error}"
                yield pa.RecordBatch.from_pylist([{**row, "content": content, "problem": problem}], schema=layout)

    layout = pa.schema(
        [("url", pa.string()), ("file_name", pa.string()), ("content", pa.binary()), ("problem", pa.string())]
    )
    wanted = df.select(F.col(url).alias("url")).where("url IS NOT NULL").distinct().repartition(requests_at_once)
    named = wanted.select("url", last_segment("url").alias("file_name"), has_scheme("url").alias("valid"))
    return named.mapInArrow(pull, RESULT)
