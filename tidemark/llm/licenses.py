"""License scan: an exact set-similarity join of text blocks with license templates.

A template is found where some block of consecutive words holds at least its threshold of the template's distinct words.
All words of the templates are ordered by their frequency in the whole corpus, rarest first. A block that meets the
threshold must hold one of the |T| - need + 1 rarest words of the template (prefix filter); a hit on the k-th word of
that order leaves |T| - k words to find, which bounds k (positional filter); and a block with fewer than ``need`` distinct
words is never compared (length filter). So only the surroundings of rare words are joined and verified. The words that
name a license and its version must all be in the block, and words that name another one must not.

Phrases are templates that must stand word for word; the same join finds them by their rarest word.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import let
from tidemark.session import materialise

# Everything in ASCII that is neither a digit nor a lower-case letter ends a word.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A label with the words that stand for it; ``exact`` asks for the words in order, without gaps.

    A block must hold all words of ``named`` and none of ``barred``, besides the threshold.
    """

    label: str
    text: str
    threshold: float = 0.8
    slack: float = 1.25
    exact: bool = False
    named: tuple[str, ...] = ()
    barred: tuple[str, ...] = ()

    @property
    def words(self) -> list[str]:
        import re

        return re.findall(WORD, self.text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))

    @property
    def distinct(self) -> list[str]:
        return list(dict.fromkeys(self.words))

    @property
    def need(self) -> int:
        return len(self.distinct) if self.exact else math.ceil(self.threshold * len(self.distinct) - 1e-9)

    @property
    def width(self) -> int:
        return len(self.words) if self.exact else math.ceil(self.slack * len(self.words))


# The phrases every scan looks for.
PHRASES = (
    Template("cc-by", "cc by", exact=True),
    Template("gpl", "general public license", exact=True),
    Template("reserved", "all rights reserved", exact=True),
)

# Opening sentences of public licenses.
LICENSES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", named=("apache", "2", "0")),
    Template("mit", "Released under the MIT License", named=("mit", "license")),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    Template(
        "gpl-3.0", "This work is licensed under the GNU General Public License, version 3",
        named=("general", "public", "3"), barred=("lesser", "affero"),
    ),
    Template(
        "gpl-2.0", "This work is licensed under the GNU General Public License, version 2",
        named=("general", "public", "2"), barred=("lesser", "affero", "3"),
    ),
    Template(
        "cc-by-4.0", "Licensed under a Creative Commons Attribution 4.0 International License",
        named=("creative", "commons", "attribution", "4", "0"),
        barred=("noncommercial", "noderivatives", "sharealike"),
    ),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", threshold=1.0),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    Template(
        "mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        named=("mozilla", "2", "0"),
    ),
)


def words(text: str) -> Column:
    """The words of a text with A-Z lower-cased; a NULL text has none."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def frequencies(docs: DataFrame, text: str, vocabulary: list[str]) -> dict[str, int]:
    """How often every word of the templates occurs in all texts; one row per template word comes to the driver."""
    found = docs.select(F.explode(words(text)).alias("word")).where(F.col("word").isin(vocabulary))
    return {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}


def prefix_index(spark: SparkSession, templates: tuple[Template, ...], counts: dict[str, int]) -> DataFrame:
    """(word, label, tokens, need, width, exact, offset, named, barred): the words by which a template is looked up.

    Its size is that of the template list, so it is broadcast.
    """
    rows = []
    for t in templates:
        ordered = sorted(t.distinct, key=lambda w: (counts.get(w, 0), w))
        for word in ordered[: len(ordered) - t.need + 1]:
            rows.append(
                F.struct(
                    F.lit(word).alias("word"),
                    F.lit(t.label).alias("label"),
                    F.array(*[F.lit(w) for w in (t.words if t.exact else t.distinct)]).alias("tokens"),
                    F.lit(t.need).alias("need"),
                    F.lit(t.width).alias("width"),
                    F.lit(t.exact).alias("exact"),
                    F.lit(t.words.index(word)).alias("offset"),
                    F.array(*map(F.lit, t.named)).cast("array<string>").alias("named"),
                    F.array(*map(F.lit, t.barred)).cast("array<string>").alias("barred"),
                )
            )
    return spark.range(1).select(F.inline(F.array(*rows)))


def blocks(docs: DataFrame, key: str, text: str, rare: list[str], reach: int) -> DataFrame:
    """(uid, key, n_words, hits): per row the places of rare words, each with up to ``reach`` words on both sides.

    Written once, so that the row number is the same for all readers.
    """

    def around(w: Column) -> Column:
        place = F.array_compact(F.transform(w, lambda word, i: F.when(word.isin(rare), i)))
        hits = F.transform(
            place,
            lambda p: F.struct(
                p.alias("at"),
                F.element_at(w, p + 1).alias("word"),
                F.least(p, F.lit(reach)).alias("inside"),
                F.slice(w, F.greatest(p - reach, F.lit(0)) + 1, 2 * reach + 1).alias("near"),
            ),
        )
        return F.struct(F.size(w).cast("long").alias("n_words"), hits.alias("hits"))

    rows = docs.select(F.col(key).alias("doc_id"), let(words(text), around).alias("found"))
    return materialise(rows.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "found.*"), "license-blocks")


def matches(found: DataFrame, index: DataFrame) -> DataFrame:
    """(uid, label, exact, at, containment): the hits that verify, one row per hit and template."""
    hits = found.select("uid", F.explode("hits").alias("hit")).select("uid", "hit.*")
    near = hits.join(F.broadcast(index), "word").where(F.size(F.array_distinct("near")) >= F.col("need"))
    begin = F.col("inside") - F.col("offset")
    in_order = (begin >= 0) & (F.slice("near", F.greatest(begin, F.lit(0)) + 1, F.col("width")) == F.col("tokens"))
    starts = F.sequence(F.greatest(F.col("inside") - F.col("width") + 1, F.lit(0)), F.col("inside"))

    def common(block: Column) -> Column:
        fits = (F.size(F.array_except("named", block)) == 0) & ~F.arrays_overlap("barred", block)
        return F.when(fits & (F.size(F.array_distinct(block)) >= F.col("need")), F.size(F.array_intersect(block, "tokens")))

    held = F.array_max(F.transform(starts, lambda s: let(F.slice("near", s + 1, F.col("width")), common)))
    overlap = F.when(F.col("exact"), F.when(in_order, F.size("tokens")).otherwise(0)).otherwise(held)
    verified = near.withColumn("overlap", overlap).where(
        F.when(F.col("exact"), F.col("overlap") > 0).otherwise(F.col("overlap") >= F.col("need"))
    )
    return verified.select(
        "uid",
        "label",
        "exact",
        (F.col("at") - F.when(F.col("exact"), F.col("offset")).otherwise(F.lit(0))).cast("long").alias("at"),
        (F.col("overlap") / F.size("tokens")).alias("containment"),
    )


def scan(
    docs: DataFrame, key: str, text: str,
    phrases: tuple[Template, ...] = PHRASES, templates: tuple[Template, ...] = LICENSES,
) -> DataFrame:
    """One row per row of ``docs``: n_words, the places of phrases, the labels found and the best containment.

    A text without words, empty or NULL, has no labels, score 0 and NULL places. Repeated rows are scanned each; an empty
    table gives no rows; other columns of ``docs`` are not looked at, whatever their names.
    """
    every = (*phrases, *templates)
    vocabulary = sorted({w for t in every for w in t.distinct})
    index = prefix_index(docs.sparkSession, every, frequencies(docs, text, vocabulary))
    index = materialise(index, "license-index")
    rare = sorted(r["word"] for r in index.select("word").distinct().collect())
    found = blocks(docs, key, text, rare, max(t.width for t in every))
    base = F.col("exact")
    labels = matches(found, index).groupBy("uid").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("at"))).alias("first_word"),
        F.max(F.when(base, F.col("at"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("containment").alias("score"),
    )
    return (
        found.select("uid", "doc_id", "n_words")
        .join(labels, "uid", "left")
        .drop("uid")
        .fillna({"n_base": 0, "base_labels": "", "labels": "", "score": 0.0})
    )
