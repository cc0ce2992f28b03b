"""Benchmark decontamination: short test items inside long documents.

A containment search over MinHash sketches, partitioned by document size. The one-permutation sketch of a document keeps
the smallest shingle hash of every bin; the number of bins follows from the size class of the document, so a document of
100,000 shingles keeps the evidence that a short item needs, which one sketch length for all sizes would lose. Items are
sketched once for every size class and joined on (class, bin minimum); every pair that shares a minimum is verified by
counting exact shingles.

A shingle shared by both stays the minimum of its bin unless another one falls into the bin. With 2**e bins per shingle
that happens with probability below 2**-(e + 1), so an item that shares m shingles is missed with less than
2**-(m * (e + 1)); ``e`` is chosen from the smallest item to make this less than 2**-MISS_BITS.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import let
from tidemark.session import materialise

SHINGLE, CONTAINMENT = 5, 0.8
MISS_BITS = 34
MAX_CLASS = 40  # documents of up to 2**40 shingles
CLASS_BITS = 63  # the class takes the place of the low 6 bits of a minimum in the join key
# The items' sketches are broadcast up to this many rows (about 40 bytes each); beyond, the join shuffles.
BROADCAST_ROWS = 500_000
WORD = r"[\p{L}\p{N}]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def shingled(w: Column, of) -> Column:
    """``of(slice)`` for all runs of SHINGLE words; a shorter text is one shingle, a text without words has none."""
    runs = F.transform(F.sequence(F.lit(1), F.size(w) - SHINGLE + 1), lambda i: of(F.slice(w, i, SHINGLE)))
    none = F.slice(F.array(of(w)), 1, 0)
    return F.when(F.size(w) >= SHINGLE, runs).when(F.size(w) > 0, F.array(of(w))).otherwise(none)


def hashes(text: Column) -> Column:
    """Sorted distinct 64-bit hashes of the shingles."""
    return F.array_sort(F.array_distinct(let(words(text), lambda w: shingled(w, lambda run: F.xxhash64(run)))))


def shingle_texts(text: Column) -> Column:
    """The distinct shingles themselves, words joined by a space."""
    return F.array_distinct(let(words(text), lambda w: shingled(w, lambda run: F.array_join(run, " "))))


def size_class(n: Column) -> Column:
    """The smallest c with n <= 2**c."""
    return F.ceil(F.log2(F.greatest(n, F.lit(1)).cast("double"))).cast("int")


def bin_minima(sorted_hashes: Column, bits: Column) -> Column:
    """The first hash of every bin; a bin is the top ``bits`` bits of a hash. Hashes come sorted, so bins are runs."""
    unused = F.lit(64) - bits

    def bin_of(h: Column) -> Column:
        return F.call_function("shiftrightunsigned", h, unused)

    def first(h: Column, i: Column) -> Column:
        return (i == 0) | (bin_of(h) != bin_of(F.element_at(sorted_hashes, F.greatest(i, F.lit(1)))))

    return F.filter(sorted_hashes, first)


def join_key(minimum: Column, bits: Column) -> Column:
    return minimum.bitwiseAND(F.lit(~CLASS_BITS)).bitwiseOR(bits.cast("long"))


def sketch_items(items: DataFrame, extra_bits: int, top_class: int) -> DataFrame:
    """(join_key, item_id): the minima of every item for all size classes of documents."""
    bits = F.explode(F.sequence(F.lit(extra_bits), F.lit(min(extra_bits + top_class, 62)))).alias("bits")
    rows = items.select("item_id", "shingles", bits)
    minima = let(F.col("shingles"), lambda s: bin_minima(s, F.col("bits")))
    return rows.select("item_id", "bits", F.explode(minima).alias("h")).select(
        join_key(F.col("h"), F.col("bits")).alias("join_key"), "item_id"
    ).distinct()


def sketch_documents(docs: DataFrame, extra_bits: int) -> DataFrame:
    """(doc_id, text_hash, join_key): the minima of every document for its own size class."""

    def minima(s: Column) -> Column:
        bits = F.least(size_class(F.size(s)) + extra_bits, F.lit(62))
        return let(bits, lambda b: F.transform(bin_minima(s, b), lambda h: join_key(h, b)))

    sketch = let(hashes(F.col("_text")), minima)
    return docs.select("doc_id", F.xxhash64("_text").alias("text_hash"), F.explode(sketch).alias("join_key"))


def contained_items(
    docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment) of all pairs where the document holds enough of the item.

    Items without words are in no document; an item shorter than a shingle is found only in texts equal to it in words.
    NULL texts are empty. Repeated rows give one row; different texts under one key, of documents or of items, are taken
    one by one and give the largest containment. Rows without a key are searched like others and reported under NULL.
    Empty tables give no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    tests = items.select(F.col(item_key).alias("item_id"), F.col(item_text).alias("_item")).distinct()
    sized = tests.withColumn("shingles", hashes(F.col("_item"))).withColumn("n_item", F.size("shingles").cast("long"))
    known = materialise(sized.where("n_item > 0"), "benchmark-items")
    smallest = known.agg(F.min("n_item")).first()[0]
    schema = "doc_id long, item_id long, n_shared long, n_item long, containment double"
    if smallest is None:
        return spark.createDataFrame([], schema)
    shared = max(1, math.ceil(containment * smallest - 1e-9))
    extra_bits = max(1, math.ceil(MISS_BITS / shared) - 1)
    read = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))

    sketches = materialise(sketch_items(known, extra_bits, MAX_CLASS), "benchmark-sketches")
    small = sketches.count() <= BROADCAST_ROWS
    candidates = materialise(
        sketch_documents(read, extra_bits)
        .join(F.broadcast(sketches) if small else sketches, "join_key")
        .select("doc_id", "text_hash", "item_id")
        .distinct(),
        "benchmark-candidates",
    )
    suspects = candidates.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    held = (
        read.withColumn("text_hash", F.xxhash64("_text"))
        .join(suspects, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left_semi")
        .dropDuplicates(["doc_id", "text_hash"])
        .select("doc_id", "text_hash", F.explode(shingle_texts(F.col("_text"))).alias("shingle"))
    )
    sought = known.select(
        "item_id", F.xxhash64("_item").alias("item_hash"), "n_item", F.explode(shingle_texts(F.col("_item"))).alias("shingle")
    )
    pairs = held.join(F.broadcast(sought) if small else sought, "shingle").groupBy(
        "doc_id", "text_hash", "item_id", "item_hash", "n_item"
    ).agg(F.count("*").alias("n_shared"))
    found = candidates.select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("item_id").alias("_item")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    return (
        pairs.where(F.col("n_shared") >= F.lit(containment) * F.col("n_item") - 1e-9)
        .join(found, same & F.col("item_id").eqNullSafe(F.col("_item")), "left_semi")
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct((F.col("n_shared") / F.col("n_item")).alias("containment"), "n_shared", "n_item")).alias("m"))
        .select("doc_id", "item_id", "m.n_shared", "m.n_item", "m.containment")
    )
