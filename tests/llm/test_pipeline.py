"""The stages of the pipeline against plain versions on a small corpus, and the queries that have SQL."""

import os
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import brute
import corpus_pipeline
import oracle
from tidemark.llm import pieces, queries, toxicity

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def corpus(spark, docs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    plain.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i % 5 == 0)) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(0, brute.ITEM), (1, "nothing that any of the texts holds at all")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def rows_of(df):
    return sorted((r.doc_id, r.text or "") for r in df.where("doc_id IS NOT NULL").collect())


def test_stages_equal_brute_force(spark, corpus, monkeypatch):
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_join", "suffix_dedup", "decontamination", "sentencepiece"]
    _, near, cut, clean, last = (stage for _, stage in corpus_pipeline.STAGES)

    first = corpus_pipeline.drop_toxic(spark, docs, corpus)
    assert first.columns == columns and set(rows_of(first)) <= set(rows_of(docs))

    kept = near(spark, docs, corpus)
    groups = brute.groups(rows_of(docs))
    expected = sorted({(i, t) for i, t in rows_of(docs) if groups[i][1] == i})
    assert kept.columns == columns and rows_of(kept) == expected
    # The row without an id is a copy of one that has one.
    assert kept.where("doc_id IS NULL").count() == 0

    kept = kept.where("doc_id IS NOT NULL").cache()
    shorter = cut(spark, kept, corpus)
    plain = [raw.decode("utf-8", "ignore") for raw, _, _ in brute.kept_bytes([t for _, t in expected])]
    assert shorter.columns == columns
    assert rows_of(shorter) == sorted((i, t) for (i, _), t in zip(expected, plain, strict=True))
    assert shorter.where("n_chars <> length(text)").count() == 0

    left = clean(spark, shorter, corpus)
    bad = {i for i, _, _ in brute.contained(rows_of(shorter), [(0, brute.ITEM)])}
    assert bad == {110} and rows_of(left) == [r for r in rows_of(shorter) if r[0] not in bad]

    ids = {r.doc_id: r.ids for r in last(spark, left, corpus).collect()}
    vocabulary = pieces.Vocabulary.load(queries.tokenizer_path(queries.PIECES))
    import numpy as np

    for i, text in rows_of(left):
        assert pieces.decode(np.array(ids[i], np.int64), np.array([len(ids[i])]), vocabulary)[0].decode() == text


CLASHING = ["doc", "_spans", "_cut", "_removed", "_spans_cut", "_kept", "_score", "score", "row", "removed", "spans", "kept",
            "is_null", "id", "node", "column_3", "text_hash", "first", "component_id"]


@pytest.fixture(scope="module")
def odd(spark, corpus, tmp_path_factory):
    """Rows that share an id, have none or no text, and extra columns with the operators' own names."""
    passage = brute.prose(random.Random(9), 120)
    rows = [
        (5, "one text about nothing in particular that stays as it is", "en", "a", 1),
        (5, "another text under the same id which has nothing to do with it", "en", "a", 1),
        (7, f"{passage} and more", "en", "a", 1), (None, f"{passage} and more", "en", "a", 1),
        (None, "a text without id that is like no other text of the table", "en", "a", 1),
        (8, f"before it {brute.ITEM} after it", "en", "a", 1), (None, f"so {brute.ITEM} too", "en", "a", 1),
        (9, None, "en", "a", None), (9, "", "en", "a", 0), (10, None, None, None, None), (None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df = df.withColumns({c: F.lit(f"own {c}") for c in CLASHING}).repartition(3)
    path = str(tmp_path_factory.mktemp("odd") / "documents")
    df.write.parquet(path)
    return spark.read.parquet(path)


def texts_of(df):
    return sorted(((r.doc_id is None, r.doc_id or 0, r.text is None, r.text or "") for r in df.collect()))


def test_stages_take_every_row_by_itself(spark, corpus, odd, monkeypatch):
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    toxic, near, cut, clean, last = (stage for _, stage in corpus_pipeline.STAGES)
    given = texts_of(odd)
    kept = near(spark, odd, corpus)
    # Only the copy without an id goes.
    gone = [r for r in given if r not in texts_of(kept)]
    assert len(gone) == 1 and gone[0][0] and len(texts_of(kept)) == len(given) - 1
    left = clean(spark, odd, corpus)
    assert [r for r in given if r not in texts_of(left)] == [r for r in given if brute.ITEM in r[3]]
    shorter = cut(spark, odd, corpus)
    assert [r[:3] for r in texts_of(shorter)] == [r[:3] for r in given]
    assert sum(r[3] != "" for r in texts_of(shorter)) == sum(r[3] != "" for r in given) - 1
    for df in (kept, left, shorter, toxic(spark, odd, corpus)):
        assert df.columns == odd.columns
        assert all(r[c] == f"own {c}" for r in df.collect() for c in CLASHING)
    assert last(spark, odd, corpus).count() == len(given)


def test_decontamination_runs_no_python(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    left = corpus_pipeline.drop_contaminated(spark, docs, corpus)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
    # Only the few rows to drop are sent round, not the texts.
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_stages_of_an_empty_table(spark, corpus, odd, monkeypatch):
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.where("false"), corpus).collect() == []


def test_run_applies_all_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "lang", "source", "ids", "n_pieces"]
    assert 0 < got.count() < queries.table(spark, SF, "documents").count()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert oracle.mismatch(queries.QUERIES[name](spark, SF), oracle.connect(SF), queries.SQL[name]) is None


def test_every_operator_is_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
