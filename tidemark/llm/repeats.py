"""Exact removal of repeated passages: every 100-byte string that has occurred before goes.

Suffixes are brought together by content before they are sorted. The minimiser of a 100-byte string, its 32-byte piece
with the smallest hash, depends on the string alone, so equal strings have equal minimisers; consecutive strings of a
document mostly share theirs and form a run with one context. Of equal contexts of one minimiser all but the first are
repeats as a whole. What is left to sort are minimisers with several different contexts, the borders of passages and
edited copies: a task writes these contexts to one text, orders its suffixes by induced sorting with queues that spill to
disk (``induced``), and reads equal strings off neighbours in that order. A minimiser with more contexts than a task should
hold is dealt out string by string instead: two hashes of a string bring its positions together, wherever they are.

Positions order by document, then by byte. A document is a pair of key and text, and documents with one key are ordered
by a hash of the text; identical rows are one document and get the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import (
    gather, mix, picked_by, powers, release_memory, slices, string_bytes, texts, without_keys,
)
from tidemark.llm.induced import suffix_batches
from tidemark.operators.numbering import number_rows
from tidemark.session import materialise

LENGTH, PIECE = 100, 32
REACH = LENGTH - PIECE + 1  # pieces in a string
BASE = 0x9E3779B97F4A7C15
SECOND = 0xD1342543DE82EF95
SLICE = 1 << 20
# A shard of contexts is about this large; one minimiser's contexts stay together up to HOT_BYTES.
SHARD_BYTES, HOT_BYTES = 16 << 20, 1 << 20
SCRAMBLED = mix(np.arange(1, 257, dtype=np.uint64))


class Substrings:
    """Hashes of any substrings of some bytes, from prefix sums."""

    def __init__(self, raw: np.ndarray, base: int = BASE):
        self.back = powers(pow(base, -1, 1 << 64), len(raw) + 1)
        terms = SCRAMBLED[raw] * powers(base, len(raw))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])

    def every(self, length: int) -> np.ndarray:
        """Of all substrings of one length."""
        n = len(self.sums) - length
        return mix((self.sums[length:] - self.sums[:-length]) * self.back[:n]) if n > 0 else np.zeros(0, np.uint64)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts])


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every run of ``width`` values: from minima towards both ends of blocks."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def runs(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, first start, number of starts, minimiser's distance from it, hashes of minimiser and context)."""
    lengths = np.diff(offsets)
    substrings = Substrings(raw)
    pieces = substrings.every(PIECE)
    bits = max(1, int(len(raw)).bit_length())
    low = np.uint64((1 << bits) - 1)
    # Hash above, place below: the minimum is the leftmost of the smallest.
    marked = (pieces & ~low) | np.arange(len(pieces), dtype=np.uint64)
    chosen = (sliding_minimum(marked, REACH) & low).astype(np.int64)
    document = np.repeat(np.arange(len(lengths)), np.maximum(lengths - LENGTH + 1, 0))
    per = np.maximum(lengths - LENGTH + 1, 0)
    starts = np.arange(len(document)) - np.repeat(np.cumsum(per) - per, per) + offsets[document]
    own = chosen[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (own[1:] != own[:-1]) | (document[1:] != document[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    begin, anchor = starts[first], own[first]
    context = substrings.of(begin, begin + count + LENGTH - 1) ^ mix((anchor - begin).astype(np.uint64))
    return document[first], begin - offsets[document[first]], count, anchor - begin, pieces[anchor], context


def anchored(docs: DataFrame) -> DataFrame:
    """(anchor, context, doc, place) of all runs. ``place`` packs first start, repeat flag, distance and count.

    Of equal contexts in a slice all but the first are known repeats: they are flagged and get a key of their own, so a
    passage that a large part of all documents holds is not sent to one task by all of them. Identical rows have the same
    document number, so they hold the same runs, which are given once; the first run's copies are no repeats of it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                raw, offsets = string_bytes(texts(part, "text"))
                if len(raw) < LENGTH:
                    continue
                document, start, count, distance, anchor, context = runs(raw, offsets)
                doc = part.column("doc").to_numpy(zero_copy_only=False)[document]
                order = np.lexsort((start, doc, context, anchor))
                order = order[_fresh(anchor[order], context[order], doc[order], start[order])]
                anchor, context, doc, start, distance, count = (
                    v[order] for v in (anchor, context, doc, start, distance, count)
                )
                again = ~_fresh(anchor, context)
                spread = mix(doc.view(np.uint64) ^ mix(start.astype(np.uint64)))
                anchor = np.where(again, spread, anchor)
                place = (start << 16) | (again.astype(np.int64) << 15) | (distance << 8) | count
                columns = [pa.array(v) for v in (anchor.view(np.int64), context.view(np.int64), doc, place)]
                yield pa.RecordBatch.from_arrays(columns, names=["anchor", "context", "doc", "place"])
        release_memory()

    return docs.select("doc", "text").mapInArrow(run, "anchor long, context long, doc long, place long")


def _fresh(*columns: np.ndarray) -> np.ndarray:
    """Whether a row of sorted columns differs from the one before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def repeats_and_questions(rows: DataFrame) -> DataFrame:
    """(repeat, anchor, doc, start, n): runs that are repeats as a whole, and one run of every context of a minimiser
    that has several. Rows come sorted by minimiser, context and position, so a task keeps one row, never a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, several = None, False  # the last first-of-its-context row; whether another context stands before it
        last = None
        for batch in batches:
            anchor, context, doc, place = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            flagged = (place >> 15) & 1 == 1
            yield _spans(True, anchor[flagged], doc[flagged], place[flagged])
            rest = ~flagged
            anchor, context, doc, place = anchor[rest], context[rest], doc[rest], place[rest]
            if not len(anchor):
                continue
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1])
            if last is not None:
                new[0] = last[:2] != (anchor[0], context[0])
            same = np.zeros(len(anchor), bool)
            same[1:] = (doc[1:] == doc[:-1]) & (place[1:] == place[:-1]) & ~new[1:]
            if last is not None:
                same[0] = not new[0] and last[2:] == (doc[0], place[0])
            # Identical rows are one document: a copy of a first row is no repeat of it.
            again = ~new & ~same
            yield _spans(True, anchor[again], doc[again], place[again])
            last = (anchor[-1], context[-1], doc[-1], place[-1])
            first = np.flatnonzero(new)
            cols = [c[first] for c in (anchor, doc, place)]
            if held is not None:
                cols = [np.concatenate([[h], c]) for h, c in zip(held, cols, strict=True)]
            if not len(cols[0]):
                continue
            equal = cols[0][1:] == cols[0][:-1]
            many = np.concatenate([[several], equal]) | np.concatenate([equal, [False]])
            held, several = [c[-1] for c in cols], bool(many[-1])
            out = np.flatnonzero(many[:-1])
            yield _spans(False, *[c[out] for c in cols])
        if held is not None and several:
            yield _spans(False, *[np.array([h]) for h in held])

    ordered = rows.repartition("anchor").sortWithinPartitions("anchor", "context", "doc", "place")
    return ordered.mapInArrow(run, "repeat boolean, anchor long, doc long, start long, n int")


def _spans(repeat: bool, anchor: np.ndarray, doc: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(np.full(len(anchor), repeat)), pa.array(anchor, pa.int64()), pa.array(doc, pa.int64())]
    columns += [pa.array(place >> 16, pa.int64()), pa.array((place & 0xFF).astype(np.int32))]
    return pa.RecordBatch.from_arrays(columns, names=["repeat", "anchor", "doc", "start", "n"])


def contexts(docs: DataFrame, questions: DataFrame) -> DataFrame:
    """(anchor, doc, start, n, raw): the bytes of every run that has to be sorted, with its strings' tails."""
    wanted = questions.groupBy("doc").agg(F.collect_list(F.struct("anchor", "start", "n")).alias("runs"))
    known = docs.where(picked_by(questions.select("doc").distinct())(F.col("doc")))
    held = known.join(wanted, "doc").select("doc", F.col("text").cast("binary").alias("raw"), F.explode("runs").alias("run"))
    piece = F.expr(f"substring(raw, cast(run.start as int) + 1, run.n + {LENGTH - 1})")
    return held.select("run.anchor", "doc", "run.start", "run.n", piece.alias("raw"))


def dealt_strings(rows: DataFrame) -> DataFrame:
    """(anchor, context, doc, place) of the single strings of contexts: two hashes stand for minimiser and context.

    As in ``anchored``, of equal strings in a slice only the first is looked up; runs of the others are flagged.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "raw", SLICE):
                raw, offsets = string_bytes(part.column("raw"))
                docs, begins, n = (part.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "start", "n"))
                at, row = gather(offsets[:-1], n.astype(np.int64)), np.repeat(np.arange(len(n)), n)
                doc, start = docs[row], begins[row] + at - offsets[row]
                one, two = (Substrings(raw, base).every(LENGTH)[at] for base in (BASE, SECOND))
                order = np.lexsort((start, doc, two, one))
                order = order[_fresh(one[order], two[order], doc[order], start[order])]
                new = _fresh(one[order], two[order])
                first, again = order[new], np.sort(order[~new])
                begin = np.flatnonzero(_fresh(row[again], start[again] - np.arange(len(again))))
                count, again = np.diff(np.append(begin, len(again))), again[begin]
                spread = mix(doc[again].view(np.uint64) ^ mix(start[again].astype(np.uint64)))
                place = np.concatenate([(start[first] << 16) | 1, (start[again] << 16) | (1 << 15) | count])
                both = np.concatenate([first, again])
                anchor = np.concatenate([one[first], spread])
                columns = [pa.array(v) for v in (anchor.view(np.int64), two[both].view(np.int64), doc[both], place)]
                yield pa.RecordBatch.from_arrays(columns, names=["anchor", "context", "doc", "place"])
        release_memory()

    return rows.mapInArrow(run, "anchor long, context long, doc long, place long")


def sorted_repeats(rows: DataFrame, shards: int) -> DataFrame:
    """(doc, start, n): runs of strings that occur before, in the suffix order of all contexts of a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, docs, begins, counts = [], [], [], []
        for batch in batches:
            parts += [np.frombuffer(b, np.uint8) for b in batch.column("raw").to_pylist()]
            docs.append(batch.column("doc").to_numpy(zero_copy_only=False))
            begins.append(batch.column("start").to_numpy(zero_copy_only=False))
            counts.append(batch.column("n").to_numpy(zero_copy_only=False))
        if not parts:
            return
        doc, begin, count = (np.concatenate(c).astype(np.int64) for c in (docs, begins, counts))
        yield from _repeats(parts, doc, begin, count)
        release_memory()

    placed = rows.repartition(shards, "anchor").select("doc", "start", "n", "raw")
    return placed.mapInArrow(run, "doc long, start long, n int")


def _repeats(parts: list[np.ndarray], doc: np.ndarray, begin: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
    sizes = np.array([len(p) for p in parts], np.int64)
    offsets = np.cumsum(sizes + 1) - sizes - 1
    text = np.ones(int((sizes + 1).sum()) + 1, np.uint16)  # contexts end in 1, the text in 0
    for part, at in zip(parts, offsets.tolist(), strict=True):
        text[at : at + len(part)] = part
        text[at : at + len(part)] += 2
    text[-1] = 0
    parts.clear()
    run_of = np.full(len(text), -1, np.int32)
    starts = np.repeat(offsets - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    run_of[starts] = np.repeat(np.arange(len(count)), count)
    held = np.zeros(0, np.int64)  # strings of the group that the batches before have left open
    found = []
    for batch in suffix_batches(text, 258):
        batch = np.concatenate([held, batch[run_of[batch] >= 0]])
        if not len(batch):
            continue
        same = equal_strings(text, batch)
        cuts = np.flatnonzero(~same) + 1
        last = int(cuts[-1]) if len(cuts) else 0
        found.append(_later(batch[:last], same[: max(last - 1, 0)], run_of, doc, begin, offsets))
        held = batch[last:]
    if len(held):
        found.append(_later(held, np.ones(len(held) - 1, bool), run_of, doc, begin, offsets))
    positions = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    positions = np.unique(positions, axis=0) if len(positions) else positions
    new = np.ones(len(positions), bool)
    new[1:] = (positions[1:, 0] != positions[:-1, 0]) | (positions[1:, 1] != positions[:-1, 1] + 1)
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(positions))).astype(np.int32)
    columns = [pa.array(positions[first, 0]), pa.array(positions[first, 1]), pa.array(n)]
    yield pa.RecordBatch.from_arrays(columns, names=["doc", "start", "n"])


def equal_strings(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Whether neighbours in suffix order have LENGTH characters in common, compared character by character."""
    same = np.zeros(len(order) - 1, bool)
    equal = np.arange(len(order) - 1)
    for i in (LENGTH - 1, *range(LENGTH - 1)):
        equal = equal[text[order[equal] + i] == text[order[equal + 1] + i]]
    same[equal] = True
    return same


def _later(order, same, run_of, doc, begin, offsets) -> np.ndarray:
    """(doc, start) of all strings of groups of equal neighbours but the first position of each group."""
    if not len(order):
        return np.zeros((0, 2), np.int64)
    group = np.concatenate([[0], np.cumsum(~same)])
    several = np.bincount(group)[group] > 1
    order, group = order[several], group[several]
    of = run_of[order]
    where = np.stack([doc[of], begin[of] + order - offsets[of]], axis=1)
    by = np.lexsort((where[:, 1], where[:, 0], group))
    group, where = group[by], where[by]
    new = np.ones(len(by), bool)
    new[1:] = group[1:] != group[:-1]
    first = where[np.flatnonzero(new)][np.cumsum(new) - 1]
    # Identical rows are one document: a copy of the first position stays with it.
    return where[np.any(where != first, axis=1)]


def numbered(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` with a number ``doc`` that orders documents: the key itself where it is unique and present."""
    pairs = docs.select(F.col(key).cast("long").alias("_k"), F.xxhash64(text).alias("_h"))
    counts = pairs.agg(F.count("*"), F.count_distinct("_k")).first()
    if counts[0] == counts[1]:
        return docs.withColumn("doc", F.col(key).cast("long"))
    order = number_rows(pairs.distinct(), ["_k", "_h"], "doc")
    same = F.col(key).cast("long").eqNullSafe(F.col("_k")) & (F.xxhash64(text) == F.col("_h"))
    return materialise(docs.join(order, same).drop("_k", "_h"), "numbered-documents")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc, start, n): runs of n consecutive repeated strings, from columns doc and text."""
    found = materialise(repeats_and_questions(anchored(docs)), "repeat-runs")
    questions = found.where("NOT repeat")
    size = questions.agg(F.coalesce(F.sum(F.col("n") + LENGTH), F.lit(0))).first()[0]
    whole = found.where("repeat").select("doc", "start", "n")
    if not size:
        return whole
    fewest = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(fewest, -(-int(size) // SHARD_BYTES))
    sizes = questions.groupBy("anchor").agg(F.sum(F.col("n") + LENGTH).alias("size"))
    hot = materialise(sizes.where(F.col("size") > HOT_BYTES).select("anchor"), "repeat-hot")
    if not hot.isEmpty():
        # There are more of these minimisers the larger the corpus is, so nothing asks for a broadcast of them.
        often = questions.where(picked_by(hot)(F.col("anchor"))).join(hot, "anchor", "left_semi")
        questions = without_keys(questions, "anchor", hot)
        dealt = repeats_and_questions(dealt_strings(contexts(docs, often))).where("repeat")
        whole = whole.unionByName(materialise(dealt.select("doc", "start", "n"), "repeat-dealt"))
    more = materialise(sorted_repeats(contexts(docs, questions), shards), "repeat-strings")
    return whole.unionByName(more)


def with_kept_bytes(docs: DataFrame, key: str, text: str, removed: str, spans: str, kept: str) -> DataFrame:
    """``docs`` with the bytes that stay, how many went, and in how many maximal runs.

    NULL texts are empty. Texts shorter than a string keep all bytes. An empty table gives no rows. The names ``doc``,
    ``_spans`` and ``_cut`` are the operator's own and replace columns of that name; other columns are kept.
    """
    docs = docs.drop("doc", "_spans", "_cut", kept, removed, spans)
    read = numbered(docs.withColumn(text, F.coalesce(F.col(text), F.lit(""))), key, text)
    found = repeated_spans(read.select("doc", F.col(text).alias("text")))
    found = materialise(
        found.groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("_spans")), "repeat-spans"
    )
    picked = picked_by(found.select("doc"))(F.col("doc"))
    some, none = read.where(picked).join(found, "doc", "left"), read.where(~picked)

    @F.pandas_udf("kept binary, removed long, spans long")
    def cut(held: pd.Series, where: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_cut(t, s) for t, s in zip(held, where, strict=True)], columns=["kept", "removed", "spans"])

    parts = some.withColumn("_cut", cut(F.col(text), F.col("_spans")))
    shorter = parts.withColumns({kept: F.col("_cut.kept"), removed: F.col("_cut.removed"), spans: F.col("_cut.spans")})
    nothing = F.lit(0).cast("long")
    whole = none.withColumns({kept: F.col(text).cast("binary"), removed: nothing, spans: nothing})
    return shorter.drop("_cut", "_spans", "doc").unionByName(whole.drop("doc"))


def valid_text(kept: str):
    """The kept bytes as text; bytes of a character that was cut in two are left out."""

    @F.pandas_udf("string")
    def decode(held: pd.Series) -> pd.Series:
        return held.map(lambda raw: bytes(raw).decode("utf-8", "ignore"))

    return decode(F.col(kept))


def _cut(text: str, spans) -> tuple[bytes, int, int]:
    raw = text.encode()
    if spans is None or not len(spans):
        return raw, 0, 0
    kept, at, removed, n = [], 0, 0, 0
    end = -1
    for span in sorted((s["start"], s["start"] + s["n"] - 1 + LENGTH) for s in spans):
        if span[0] > end:
            n += 1
        begin = max(span[0], at)
        if begin > at:
            kept.append(raw[at:begin])
        removed += max(0, span[1] - begin)
        at, end = max(at, span[1]), max(end, span[1])
    kept.append(raw[at:])
    return b"".join(kept), removed, n
