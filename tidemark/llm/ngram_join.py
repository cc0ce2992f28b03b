"""Near-duplicate documents: an exact Jaccard self-join of word n-gram sets with token-combination prefixes.

The n-grams ("tokens") of a document are ordered by frequency class, rarest first. Two sets with enough overlap share
their first common token within both prefixes, and their first two common tokens within prefixes that are one token
longer. A rare token is therefore indexed alone; of the frequent tokens of an extended prefix all pairs are indexed, so that
fewer sets meet than would for one frequent token. The pairs of a long prefix are very many: sets of more than ``LARGE``
n-grams, and all that could be similar to one, are indexed by every single token of their prefix instead.

Links are found in rounds. A few rounds compare every set with one partner, the likeliest among the sets drawn for its
keys; they join the copies of a family to each other in time linear in the family. Then, for all
keys that still hold sets of several components, every pair of sets from different components that passes the length and
positional filters and a bound on the difference is compared. No pair that could link two components is left out, and
pairs inside a component need not be listed.

Documents with equal sets are one node from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import FNV_PRIME, coded_words, gather, hash_strings, mix, picked_by, release_memory, slices, texts
from tidemark.llm.components import components
from tidemark.session import materialise

SHINGLE = 5
# Similarity as a fraction, so that all comparisons are between whole numbers.
NUMERATOR, DENOMINATOR = 4, 5
# A token is in the frequent class if it is seen in this share of the documents. The counts of at most KNOWN_TOKENS, the
# most frequent ones, are told to the tasks and order the tokens; both only move work and change no result.
FREQUENT_SHARE, KNOWN_TOKENS = 0.01, 1 << 20
# Sets of up to this many shingles are indexed by pairs of their frequent tokens.
LARGE = 1000
# Rounds with one partner per set before the pairs that are left.
ROUNDS = 2
# Words of 64 parities per set, by which pairs that differ too much are told before their texts are compared.
WORDS = 8
PARITIES = [f"p{i}" for i in range(WORDS)]
# Sets of more shingles than these have classes have more parities besides: so many classes per shingle, and up to twice.
CLASSES = 4
# A task works on this many bytes of texts at a time.
SLICE = 1 << 20
# Tables of up to this many rows of a few numbers, counted after they are written, are broadcast; larger ones shuffle.
BROADCAST_ROWS = 300_000


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of the texts, hashes of their distinct shingles in ascending order) of texts without NULLs."""
    offsets, codes, distinct = coded_words(pc.ascii_split_whitespace(pc.ascii_lower(column)))
    words, sizes = hash_strings(distinct)[codes], np.diff(offsets)
    prime = np.uint64(FNV_PRIME)
    text = np.repeat(np.arange(len(sizes)), sizes)
    whole = np.flatnonzero(np.arange(len(words)) + SHINGLE <= offsets[1:][text]) if len(words) else np.zeros(0, np.int64)
    value = np.full(len(whole), SHINGLE, np.uint64)
    for i in range(SHINGLE):
        value = value * prime + words[whole + i]
    of, found = [text[whole]], [value]
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    value = sizes[short].astype(np.uint64)
    for i in range(SHINGLE - 1):
        on = sizes[short] > i
        value[on] = value[on] * prime + words[offsets[short[on]] + i]
    of, value = np.concatenate([*of, short]), mix(np.concatenate([*found, value]))
    order = np.argsort(value)
    # Rows of a slice mostly fit 16 bits, for which the stable sort is a radix sort.
    narrow = of[order].astype(np.uint16 if len(sizes) < 1 << 16 else np.int64)
    order = order[np.argsort(narrow, kind="stable")]
    of, value = of[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (of[1:] != of[:-1]) | (value[1:] != value[:-1])
    counts = np.bincount(of[new], minlength=len(sizes))
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64), value[new]


def set_digests(offsets: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """One 64-bit digest per set; together with the size it names the set."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(0x5EED)), dtype=np.uint64)])
    return mix((sums[offsets[1:]] - sums[offsets[:-1]]) ^ mix(np.diff(offsets).astype(np.uint64)))


def need(size: np.ndarray) -> np.ndarray:
    """The least overlap a set of this size must have with a similar one."""
    return -(-NUMERATOR * size // DENOMINATOR)


def first_of_each(digests: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of the first copy of every set that is not empty."""
    places = np.sort(np.unique(digests, return_index=True)[1])
    return places[sizes[places] > 0]


def describe(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One pass over all texts. Rows of kind 0: (id, node, n) of every document; of kind 1: a token that several sets of
    a slice hold, and how many; of kind 2: the parities of a set, once per slice. Tokens of a large part of the corpus
    repeat in every slice, so their sums are near their true counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, SLICE):
                offsets, hashes = shingle_sets(texts(part, text))
                sizes, digests = np.diff(offsets), set_digests(offsets, hashes)
                yield _typed(0, part.column(key), digests, sizes)
                one = first_of_each(digests, sizes)
                tokens, counts = np.unique(hashes[gather(offsets[one], sizes[one])], return_counts=True)
                several = counts >= 2
                none = pa.nulls(int(several.sum()), pa.int64())
                yield _typed(1, none, tokens[several], counts[several])
                bits, more = parities(offsets, hashes)[one], [more_parities(hashes[offsets[i] : offsets[i + 1]]) for i in one]
                yield _typed(2, pa.nulls(len(one), pa.int64()), digests[one], sizes[one], bits, more)
        release_memory()

    rows = docs.select(F.col(key).cast("long").alias(key), text)
    fields = ["kind int", "id long", "node long", "n long", *[f"{p} long" for p in PARITIES], "more binary"]
    return rows.mapInArrow(run, ", ".join(fields))


def _typed(
    kind: int, ids: pa.Array, nodes: np.ndarray, n: np.ndarray, bits: np.ndarray | None = None, more: list | None = None
) -> pa.RecordBatch:
    kinds = pa.array(np.full(len(nodes), kind, np.int32))
    columns = [kinds, ids, pa.array(nodes.view(np.int64)), pa.array(n.astype(np.int64))]
    columns += [pa.nulls(len(nodes), pa.int64()) if bits is None else pa.array(bits[:, i]) for i in range(WORDS)]
    columns.append(pa.array(more or [None] * len(nodes), pa.binary()))
    return pa.RecordBatch.from_arrays(columns, names=["kind", "id", "node", "n", *PARITIES, "more"])


def parities(offsets: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each of WORDS x 64 classes of tokens whether the set holds an odd number of them, a row of numbers per set.

    Where two sets differ in d tokens, at most d of these bits differ.
    """
    sizes, classes = np.diff(offsets), WORDS * 64
    place = np.repeat(np.arange(len(sizes)), sizes) * classes + (hashes >> np.uint64(40)).astype(np.int64) % classes
    odd = (np.bincount(place, minlength=len(sizes) * classes) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(-1, classes), axis=1).view(np.int64)


def more_parities(hashes: np.ndarray) -> bytes | None:
    """The same of one large set for a power of two of classes that is in proportion to its size; None for small sets."""
    if len(hashes) <= WORDS * 64:
        return None
    classes = 1 << (CLASSES * len(hashes) - 1).bit_length()
    odd = np.bincount(((hashes >> np.uint64(20)) & np.uint64(classes - 1)).astype(np.int64), minlength=classes) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def differing_more(a: bytes | None, b: bytes | None) -> int:
    """How many of these parities differ. The longer row is folded: two classes together hold an odd number if one does."""
    if a is None or b is None:
        return 0
    x, y = sorted((np.frombuffer(v, np.uint8) for v in (a, b)), key=len)
    folded = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ folded).sum())


def known_tokens(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(tokens in ascending order, their counts) of the most frequent tokens, KNOWN_TOKENS at most."""
    total = materialise(counts.groupBy("node").agg(F.sum("n").alias("n")), "token-counts")
    level = F.floor(F.log2("n") * 8)
    held, cut = 0, None
    for row in sorted(total.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
        if held + row["count"] > KNOWN_TOKENS:
            break
        held, cut = held + row["count"], row["level"]
    if cut is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # As Arrow columns: a Python object per row would take the driver ten times their size.
    rows = total.where(level >= cut).select("node", "n").toArrow()
    tokens = rows["node"].to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], rows["n"].to_numpy()[order]


def index_keys(
    offsets: np.ndarray, hashes: np.ndarray, tokens: np.ndarray, counts: np.ndarray, least: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set, key, position) of all sets: rare prefix tokens, and pairs of frequent ones.

    Where one of two similar sets is larger than LARGE, neither is smaller than need(LARGE): sets from there on have
    their frequent prefix tokens as keys too, and those above LARGE have no pairs. The position says how many tokens of the set are not common if the key holds the first common tokens of a pair.

    ``tokens`` with their ``counts`` order the tokens of a set; those with a count of ``least`` or more are frequent.
    """
    sizes = np.diff(offsets)
    of = np.repeat(np.arange(len(sizes)), sizes)
    place = np.minimum(np.searchsorted(tokens, hashes), max(len(tokens) - 1, 0))
    rank = np.zeros(len(hashes), np.int64)
    if len(tokens):
        hit = tokens[place] == hashes
        rank[hit] = counts[place[hit]]
    # Hashes ascend within a set; tokens with a count go to its end, in the order of their counts.
    order = np.lexsort((hashes, rank, of)) if rank.any() else np.arange(len(hashes))
    value, often = hashes[order], rank[order] >= max(least, 1)
    position = np.arange(len(hashes)) - np.repeat(offsets[:-1], sizes)
    prefix, size = np.repeat(sizes - need(sizes) + 1, sizes), np.repeat(sizes, sizes)
    alone = (position < prefix) & (~often | (size >= need(np.array([LARGE]))))
    sets, keys, places = [of[alone]], [value[alone]], [position[alone]]
    extended = (position < prefix + 1) & often & (size <= LARGE)
    counts_in = np.bincount(of[extended], minlength=len(sizes))
    where = np.flatnonzero(extended)
    begins = np.cumsum(counts_in) - counts_in
    for s in np.flatnonzero(counts_in >= 2):
        own = where[begins[s] : begins[s] + counts_in[s]]
        a, b = np.triu_indices(len(own), 1)
        sets.append(np.full(len(a), s))
        keys.append(mix(value[own[a]] * np.uint64(3) + value[own[b]]))
        # No other token of the set stands before the second of its first two common tokens and is common.
        places.append(position[own[b]] - 1)
    return np.concatenate(sets), np.concatenate(keys), np.concatenate(places)


def index(docs: DataFrame, key: str, text: str, known: tuple[np.ndarray, np.ndarray], least: float) -> DataFrame:
    """(key, n, node, at): the index rows of all sets, each set once per slice however many copies it has there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, SLICE):
                offsets, hashes = shingle_sets(texts(part, text))
                sizes, digests = np.diff(offsets), set_digests(offsets, hashes)
                one = first_of_each(digests, sizes)
                held = hashes[gather(offsets[one], sizes[one])]
                sets, keys, places = index_keys(np.concatenate([[0], np.cumsum(sizes[one])]), held, *known, least)
                columns = [keys.view(np.int64), sizes[one][sets].astype(np.int32), digests[one][sets].view(np.int64)]
                columns = [pa.array(c) for c in (*columns, places.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "n", "node", "at"])
        release_memory()

    rows = docs.where(F.col(key).isNotNull()).select(text)
    return rows.mapInArrow(run, "key long, n int, node long, at int")


def shared_keys(rows: DataFrame) -> DataFrame:
    """(key, n, node, at): the index rows whose key several sets hold.

    Rows come sorted by key, so a task keeps one row, never a group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_joined = None, False
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if last is not None:
                cols = [np.concatenate([[v], c]) for v, c in zip(last, cols, strict=True)]
            if not len(cols[0]):
                continue
            new = np.ones(len(cols[0]), bool)
            new[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[2][1:] != cols[2][:-1])
            cols = [c[new] for c in cols]
            same = cols[0][1:] == cols[0][:-1]
            joined = np.concatenate([[last_joined], same]) | np.concatenate([same, [False]])
            last, last_joined = [c[-1] for c in cols], bool(joined[-1])
            yield _shared([c[:-1][joined[:-1]] for c in cols])
        if last is not None and last_joined:
            yield _shared([np.array([v]) for v in last])

    ordered = rows.repartition("key").sortWithinPartitions("key", "n", "node")
    return ordered.mapInArrow(run, "key long, n int, node long, at int")


def _shared(cols: list[np.ndarray]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["key", "n", "node", "at"]
    )


def hinted(written: DataFrame) -> DataFrame:
    """A table that has been written, broadcast if its size allows."""
    return F.broadcast(written) if written.count() <= BROADCAST_ROWS else written


def node_texts(nodes: DataFrame, stands_for: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """(node, text): a text for every node, from the document that stands for it."""
    wanted = materialise(nodes.join(stands_for, "node"), "join-nodes")
    read = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    some = read.where(picked_by(wanted.select("id"))(F.col("id"))).join(hinted(wanted), "id").select("node", "text")
    return materialise(some, "join-texts")


def verified(pairs: DataFrame, stands_for: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """The pairs (a, b) of sets that are similar, by comparing the whole sets of the documents that stand for them."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    held = node_texts(nodes, stands_for, docs, key, text)
    left = held.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = held.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a", SLICE):
                sides, named = [], []
                for side in ("a", "b"):
                    offsets, hashes = shingle_sets(texts(part, f"text_{side}"))
                    sides.append((offsets, hashes))
                    own = part.column(side).to_numpy(zero_copy_only=False).view(np.uint64)
                    named.append(set_digests(offsets, hashes) == own)
                keep = []
                for i in np.flatnonzero(named[0] & named[1]):
                    x, y = (hashes[offsets[i] : offsets[i + 1]] for offsets, hashes in sides)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if DENOMINATOR * both >= NUMERATOR * (len(x) + len(y) - both):
                        keep.append(i)
                rows = pa.array(keep, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(s).take(rows) for s in ("a", "b")], names=["a", "b"])
        release_memory()

    # Texts are dealt out by the id of their set and never broadcast, whatever the size.
    both = left.join(hinted(pairs.select("a", "b")), "a").hint("merge").join(right.hint("merge"), "b")
    both = both.select("a", "b", "text_a", "text_b")
    return materialise(both.mapInArrow(run, "a long, b long").distinct(), "join-links")


def possible(n_a, n_b, at_a, at_b):
    """Whether sets of these sizes that first meet at these positions can be similar: length and positional filters."""
    total = NUMERATOR + DENOMINATOR
    rest = F.least(n_a - at_a, n_b - at_b)
    sizes = (n_a * DENOMINATOR >= n_b * NUMERATOR) & (n_b * DENOMINATOR >= n_a * NUMERATOR)
    return sizes & (rest * total >= (n_a + n_b) * NUMERATOR)


def pair_of(best: DataFrame) -> DataFrame:
    """(a, b), a < b, of a node and its pivot."""
    return best.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()


def not_in(pairs: DataFrame, tried: DataFrame) -> DataFrame:
    return pairs.join(tried, ["a", "b"], "left_anti")


def grouped_keys(held: DataFrame) -> DataFrame:
    """(key, n, node, at): one key for all keys that the same sets hold, with the least position of each set.

    Copies share whole runs of tokens, so many keys have the same sets. Named by a signature of the sets, they become one
    key: no pair is lost, and none is listed for every shared token.
    """
    signature = F.xxhash64(F.bit_xor(F.xxhash64("node")), F.bit_xor(F.xxhash64("node", F.lit(1))), F.count("*"))
    named = held.groupBy("key").agg(signature.alias("sets"))
    rows = held.select("key", "n", "node", "at").join(named, "key").groupBy(F.col("sets").alias("key"), "n", "node")
    return materialise(rows.agg(F.min("at").alias("at")), "join-groups")


def open_rows(rows: DataFrame, links: DataFrame) -> DataFrame:
    """The rows of keys that sets of several components hold, with the components; keys only ever close."""
    placed = rows.drop("component").join(components(links), "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    span = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return materialise(placed.join(span.where("low <> high").select("key"), "key"), "join-open")


def differing(a: str, b: str):
    """How many parities of two sets differ: no more than the tokens that only one of them holds."""
    return sum((F.bit_count(F.col(a + p).bitwiseXOR(F.col(b + p))) for p in PARITIES), F.lit(0))


def with_difference(partners: DataFrame, parity: DataFrame) -> DataFrame:
    """The pairs (node, pivot) with ``apart``, how many of their parities differ.

    Parities are not broadcast by hint, as they are wide and grow with the corpus: the driver would build and send them.
    """
    placed = partners
    for side in ("node", "pivot"):
        bits = parity.select(F.col("node").alias(side), *[F.col(p).alias(f"{side}_{p}") for p in PARITIES])
        placed = placed.join(bits, side)
    return placed.withColumn("apart", differing("node_", "pivot_"))


def still_close(pairs: DataFrame, first: str, second: str, sets: DataFrame) -> DataFrame:
    """The written pairs (two columns of nodes and any others) that may be similar by the parities of large sets, if both
    are. Only the parities of sets in pairs are shuffled."""

    @F.arrow_udf("long")
    def apart(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([differing_more(x.as_py(), y.as_py()) for x, y in zip(a, b, strict=True)], pa.int64())

    named = pairs.select(F.col(first).alias("node")).unionByName(pairs.select(F.col(second).alias("node")))
    sets, placed = sets.where(picked_by(named)(F.col("node"))), pairs
    for side in (first, second):
        own = sets.select(F.col("node").alias(side), F.col("n").alias(f"{side}_size"), F.col("more").alias(f"{side}_more"))
        placed = placed.join(own, side, "left")
    # A set that is not large is not in ``sets``.
    large = F.col(f"{first}_more").isNotNull() & F.col(f"{second}_more").isNotNull()
    far = large & ~close_enough(
        apart(f"{first}_more", f"{second}_more"), F.col(f"{first}_size"), F.col(f"{second}_size")
    )
    return placed.where(~far).select(*pairs.columns)


def close_enough(apart, n_a, n_b):
    return apart * (NUMERATOR + DENOMINATOR) <= (n_a + n_b) * (DENOMINATOR - NUMERATOR)


def similar_groups(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: the smallest key that it is linked with, directly or not.

    Texts without words and NULL texts have an empty set and are linked with nothing. Rows that share a key are rows of
    their own with one id. A row without a key takes no part and has no component. An empty table gives no rows; other
    columns of ``docs`` are not looked at, whatever their names.
    """
    both = materialise(describe(docs, key, text), "join-sets")
    members = both.where("kind = 0").select("id", "node", "n")
    named = members.where("n > 0 AND id IS NOT NULL")
    stands_for = named.groupBy("node").agg(F.min("id").alias("id"))
    known = known_tokens(both.where("kind = 1"))
    held = materialise(shared_keys(index(docs, key, text, known, members.count() * FREQUENT_SHARE)), "join-keys")

    rest = materialise(grouped_keys(held).withColumn("component", F.col("node")), "join-open")
    # Only sets that share a key with another one are ever compared.
    sharing = both.where("kind = 2").where(picked_by(rest.select("node"))(F.col("node")))
    parity = materialise(sharing.groupBy("node").agg(*[F.min(p).alias(p) for p in PARITIES]), "join-parities")
    large = sharing.where("more IS NOT NULL").groupBy("node").agg(F.first("n").alias("n"), F.first("more").alias("more"))
    large = materialise(large, "join-large")
    tried = links = docs.sparkSession.createDataFrame([], "a long, b long")
    for round_ in range(ROUNDS):
        own = F.struct("n", "node", "component")
        drawn = rest.groupBy("key").agg(F.min_by(own, F.xxhash64("node", F.lit(round_))).alias("p"))
        against = rest.join(drawn, "key").where("component <> p.component")
        partners = against.select("node", "n", F.col("p.node").alias("pivot"), F.col("p.n").alias("n_pivot")).distinct()
        likely = with_difference(partners, parity).where(close_enough(F.col("apart"), F.col("n"), F.col("n_pivot")))
        a, b = F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")
        likely = not_in(likely.select(a, b, "node", "pivot", "apart"), tried)
        best = likely.groupBy("node").agg(F.min_by("pivot", F.struct("apart", "a", "b")).alias("pivot"))
        best = materialise(pair_of(best), "join-best")
        # One pair per set meets the parities of large sets; those that are too far apart count as tried too.
        tried = tried.unionByName(best)
        again = materialise(still_close(best, "a", "b", large), "join-pairs")
        links = links.unionByName(verified(again, stands_for, docs, key, text))
        rest = open_rows(rest, links)

    # Parities stand beside the keys only here, where few sets are left, so that pairs are told apart while they are made.
    rest = materialise(rest.join(parity, "node"), "join-open")
    own = ("n", "node", "at", "component", *PARITIES)
    left, right = (rest.select("key", *[F.col(c).alias(f"{s}_{c}") for c in own]) for s in "ab")
    pairs = (
        left.join(right, "key")
        .where("a_node < b_node AND a_component <> b_component")
        .where(possible(*[F.col(c) for c in ("a_n", "b_n", "a_at", "b_at")]))
        .where(close_enough(differing("a_", "b_"), F.col("a_n"), F.col("b_n")))
        .select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
        .distinct()
    )
    left_over = still_close(materialise(not_in(pairs, tried), "join-left"), "a", "b", large)
    more = verified(materialise(left_over, "join-pairs"), stands_for, docs, key, text)
    final = components(links.unionByName(more))

    labelled = members.join(final, "node", "left").withColumn("group", F.coalesce("component", "node"))
    smallest = labelled.where("n > 0 AND id IS NOT NULL").groupBy("group").agg(F.min("id").alias("first"))
    whole = F.when(F.col("n") > 0, F.col("first")).otherwise(F.col("id"))
    return labelled.join(smallest, "group", "left").select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), whole).alias("component_id"),
    )
