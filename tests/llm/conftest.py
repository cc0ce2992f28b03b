import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from pyspark.sql import functions as F  # noqa: E402

import brute  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Rows with every awkward case: NULLs, empty, long, ties, repeats, and columns with the operators' own names."""
    rows = [(i, t, l, s, None if t is None else len(t)) for i, t, l, s in brute.documents()]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3, "text")
    clashing = ("node", "doc", "shard", "slot", "curve", "n", "key", "kind", "words", "score", "text_hash", "uid", "_text")
    return df.withColumns({c: F.lit(7) for c in clashing}).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
