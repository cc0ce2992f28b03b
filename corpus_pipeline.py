"""The corpus pipeline: five stages from raw documents to piece ids.

Each stage works on all that the one before has kept, is written to the shared folder and read again. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import benchmark, ngram_join, pieces, repeats, toxicity
from tidemark.llm.common import without_keys
from tidemark.llm.queries import PIECES, held_out, table, tokenizer_path
from tidemark.session import fresh_dir, materialise


def neutral(docs: DataFrame) -> DataFrame:
    """``docs`` with columns under numbered names, which no operator uses for its own."""
    return docs.toDF(*[f"column_{i}" for i in range(len(docs.columns))])


def place(docs: DataFrame, name: str) -> str:
    """The neutral name of a column."""
    return f"column_{docs.columns.index(name)}"


def given(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` under their own names again."""
    return df.select(*[F.col(f"column_{i}").alias(c) for i, c in enumerate(docs.columns)])


def by_row(docs: DataFrame) -> DataFrame:
    """``docs`` under neutral names with ``row``, by which a stage decides: the id, if every row has one of its own.

    Otherwise rows are numbered, and written so that all readers see the same numbers.
    """
    df, key = neutral(docs), place(docs, "doc_id")
    n, present, distinct = df.agg(F.count("*"), F.count(key), F.count_distinct(key)).first()
    if n == present == distinct:
        return df.withColumn("row", F.col(key).cast("long"))
    return materialise(df.withColumn("row", F.monotonically_increasing_id()), "pipeline-rows")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score as toxic go; labels of the held-out fold are not learned from.

    A NULL text scores like an empty one. Repeated rows score alike. An empty table stays empty, and extra columns of any
    name are kept.
    """
    labels, df = table(spark, sf_dir, "labels"), neutral(docs)
    net = toxicity.fit(labels.where(~held_out(4, 2)), docs, "doc_id", "text", "toxic")
    scored = toxicity.with_score(df, place(docs, "text"), net, "score")
    return given(scored.where(F.col("score") < toxicity.THRESHOLD), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of similar documents one row stays: that with the smallest id, of several the first.

    Every row is a document of its own, also one without id, which stays only where no member of its group has one, and
    one that shares its id with other texts. Rows without words all stay. An empty table stays empty, and extra columns
    of any name are kept.
    """
    df, key = by_row(docs), place(docs, "doc_id")
    groups = materialise(ngram_join.similar_groups(df, "row", place(docs, "text")), "pipeline-groups")
    groups = groups.withColumnRenamed("doc_id", "row").join(df.select("row", F.col(key).alias("id")), "row")
    order = F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first")
    kept = groups.groupBy("component_id").agg(order).select(F.col("first.row").alias("row"))
    return given(without_keys(df, "row", groups.select("row").join(kept, "row", "left_anti")), docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that have occurred before are cut out; a document of nothing else stays with an empty text.

    A NULL text stays NULL. Identical rows are one document and keep their text alike. An empty table stays empty, and
    extra columns of any name are kept.
    """
    df, text, size = neutral(docs), place(docs, "text"), place(docs, "n_chars")
    cut = repeats.with_kept_bytes(
        df.withColumn("is_null", F.col(text).isNull()), place(docs, "doc_id"), text, "removed", "spans", "kept"
    )
    shorter = F.when(F.col("removed") > 0, repeats.valid_text("kept")).when(~F.col("is_null"), F.col(text))
    cut = cut.withColumn(text, shorter)
    n_chars = F.when(F.col("removed") > 0, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col(size))
    return given(cut.withColumn(size, n_chars), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go, each by its own text, with or without an id.

    A NULL text holds nothing. An empty table stays empty, and extra columns of any name are kept. DataFrame operations
    only; the rows to drop are written first, so that Catalyst knows their size and broadcasts them while they are few.
    """
    df = by_row(docs)
    found = benchmark.contained_items(
        df, "row", place(docs, "text"), table(spark, sf_dir, "benchmark"), "item_id", "text"
    )
    rows = materialise(found.select(F.col("doc_id").alias("row")).distinct(), "pipeline-contaminated")
    return given(df.join(rows, "row", "left_anti"), docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every text that is left, with its id, language and source.

    A NULL text is empty and has no ids. Repeated rows and rows without id are encoded like others.
    """
    kept = "doc_id long, lang string, source string"
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("lang"), F.col("source")]
    return pieces.with_ids(docs, "text", tokenizer_path(PIECES), columns, kept).withColumn(
        "n_pieces", F.size("ids").cast("long")
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("sentencepiece", to_pieces),
]

# The network and the piece search have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
    return docs
