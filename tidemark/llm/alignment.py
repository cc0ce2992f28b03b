"""Alignment of two tokenizers over the same bytes by galloping intersection of their token ends.

Both tokenizers give every text a list of byte offsets where tokens end. The shorter list of a document is sought in the
longer one: every end probes at doubling distances from the place that its share of the list suggests, then halves the
bracket. Ends in both lists cut the text into groups, and the difference between the ranks of two neighbouring ends is the
range of tokens of the other list that one token overlaps. All ends of a slice of documents gallop together.

How often an id pair is linked in the whole corpus is counted over slices: each slice of documents is written with one
list of its distinct pairs, documents refer to places in that list, and the counts come back to the slices by a join, so
no document is encoded twice and no table of pairs is broadcast or collected by this module.

Neither tokenizer has a token across a single space between two other characters, where every text is cut into units:
equal units are encoded once as long as a task keeps them, about ``KNOWN`` bytes, and a very long text is aligned part
by part.

A NULL or empty text, and one whose tokens do not spell it byte for byte, has no tokens. Rows are taken one by one:
repeated rows and rows without id give rows of their own, but their links count like any others. Only named columns are
read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import gather, release_memory, slices, string_bytes, texts
from tidemark.session import materialise

SLICE = 1 << 20  # bytes of texts that are aligned at once
TOGETHER = 64  # units that are encoded as one text
LISTED = 8 << 20  # bytes of texts that share one list of distinct pairs
KNOWN = 2 << 20  # bytes of units whose tokens a task keeps
WIDE_SPACES = (0xC2, 0xE1, 0xE2, 0xE3)  # first bytes of all white space beyond ASCII in UTF-8
MARK = "▁"  # stands for a space in pieces
ID_BITS = 20

SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


@dataclass
class Tokenizers:
    """Both tokenizers, the bytes of every id, and every id as text with each sign that may follow it."""

    bytewise: object
    pieces: object
    raw_a: np.ndarray
    starts_a: np.ndarray
    raw_b: np.ndarray
    starts_b: np.ndarray
    sizes: tuple[np.ndarray, np.ndarray]
    signed: pa.Array
    first_b: int
    known: Known | None = None

    @classmethod
    def load(cls, bytewise: str, pieces: str) -> Tokenizers:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        # Tasks run side by side already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        a = Tokenizer.from_file(bytewise)
        a.encode_special_tokens = True
        b = SentencePieceProcessor(model_file=pieces)
        byte_of = byte_level()
        names = {i: token for token, i in a.get_vocab(with_added_tokens=True).items()}
        size_a, size_b = max(names) + 1, b.get_piece_size()
        if max(size_a, size_b) > 1 << ID_BITS:
            raise ValueError("vocabulary too large")
        raw_a = [bytes(byte_of.get(c, 63) for c in names.get(i, "")) for i in range(size_a)]
        raw_b = [
            bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace(MARK, " ").encode()
            for i in range(size_b)
        ]
        signed = [f"{i}{sign}" for i in range(size_a) for sign in ",|"]
        signed += [f"{i}{sign}" for i in range(size_b) for sign in (",", ";", "")]
        joined_a, places_a = string_bytes(pa.array(raw_a, pa.binary()))
        joined_b, places_b = string_bytes(pa.array(raw_b, pa.binary()))
        sizes = np.diff(places_a), np.diff(places_b)
        return cls(a, b, joined_a, places_a, joined_b, places_b, sizes, pa.array(signed, pa.large_string()), 2 * size_a)

    def encode(self, units: pa.Array) -> tuple[Encoded, Encoded]:
        """Every unit in both tokenizers, the first one with a space put before it.

        Units that begin and end without white space are encoded many at a time with single spaces between them, and
        told apart by the bytes of their tokens; where these do not fit, the units are encoded one by one.
        """
        raw, places = string_bytes(units)
        joinable = cuttable(raw, places[1:] - 1, places[:-1])
        new = np.arange(len(units)) % TOGETHER == 0
        new |= ~joinable
        new[1:] |= ~joinable[:-1]
        starts = np.flatnonzero(new)
        strings, ends = units.to_pylist(), np.append(starts[1:], len(units))
        chunks = pa.array([" ".join(strings[s:e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)])
        sizes, done, found = np.diff(places) + 1, 0, ([], [])
        for part in slices(pa.RecordBatch.from_arrays([chunks], names=["chunk"]), "chunk", SLICE // 16):
            joined = part.column(0).to_pylist()
            a = self.bytewise.encode_batch([" " + u for u in joined], add_special_tokens=False)
            b = self.pieces.encode(joined, num_threads=1)
            own = slice(done, done + len(joined))
            first, n_units = starts[own], ends[own] - starts[own]
            want = sizes[first[0] : ends[own][-1]]
            for side, lists in enumerate(([e.ids for e in a], b)):
                n_ids = np.fromiter(map(len, lists), np.int64, len(lists))
                ids = np.fromiter(itertools.chain.from_iterable(lists), np.int32, int(n_ids.sum()))
                counts, fits = told_apart(self.sizes[side][ids], n_ids, want, n_units)
                of_ids, of_units = (np.concatenate([[0], np.cumsum(n)]) for n in (n_ids, n_units))
                at = 0
                for k in [*np.flatnonzero(~fits).tolist(), len(lists)]:
                    found[side].append((ids[of_ids[at] : of_ids[k]], counts[of_units[at] : of_units[k]]))
                    if k < len(lists):
                        alone = [self.one(side, strings[u]) for u in range(first[k], first[k] + n_units[k])]
                        found[side].append((np.concatenate(alone), np.array([len(x) for x in alone], np.int32)))
                    at = k + 1
            done += len(joined)
        return tuple(Encoded(*map(np.concatenate, zip(*own, strict=True))) for own in found)

    def places(self, units: pa.Array) -> np.ndarray:
        """Where the tokens of distinct units stand in ``known``, which is filled with those that it does not hold.

        When it is full, units that have come only once since then are forgotten, or all.
        """
        if self.known is not None and self.known.size > KNOWN:
            often = np.flatnonzero(self.known.seen > 1)
            kept = self.known.only(often)
            self.known = kept if 2 * kept.size <= KNOWN else None
        if self.known is None:
            self.known = self.learn(units)
            return np.arange(len(units))
        found = pc.index_in(units, value_set=self.known.units)
        new = found.is_null()
        places = pc.fill_null(found, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        fresh = new.to_numpy(zero_copy_only=False)
        self.known.seen[places[~fresh]] += 1
        if fresh.any():
            places[fresh] = len(self.known.units) + np.arange(fresh.sum())
            self.known = self.known.with_more(self.learn(units.filter(new)))
        return places

    def learn(self, units: pa.Array) -> Known:
        """The tokens of units in both tokenizers, and whether these spell them."""
        sides = self.encode(units)
        space, nothing = (pa.scalar(s, units.type) for s in (" ", ""))
        spaced, places = string_bytes(pc.binary_join_element_wise(space, units, nothing))
        sizes = np.diff(places)
        spelled = sides[0].spell(self.raw_a, self.starts_a, spaced, sizes)
        spelled &= sides[1].spell(self.raw_b, self.starts_b, spaced, sizes)
        return Known(units, sides, spelled, np.ones(len(units), np.int32))

    def one(self, side: int, unit: str) -> np.ndarray:
        """The ids of one unit from one of the tokenizers."""
        ids = self.pieces.encode(unit) if side else self.bytewise.encode(" " + unit, add_special_tokens=False).ids
        return np.array(ids, np.int32)


def told_apart(
    lengths: np.ndarray, n_ids: np.ndarray, want: np.ndarray, n_units: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of every unit, whether they fit of every chunk): a token must end with each unit of a chunk.

    ``lengths`` are the bytes of the tokens, ``want`` those of the units; ``n_ids`` and ``n_units`` count them by chunk.
    The tokens of a single unit fit always. Tokens of units in a chunk that does not fit are not told.
    """
    counts = np.zeros(len(want), np.int32)
    ends, wanted = np.cumsum(lengths), np.cumsum(want)
    of_ids, of_units = np.cumsum(n_ids), np.cumsum(n_units)
    total = np.diff(np.concatenate([[0], ends])[of_ids], prepend=0)
    due = np.diff(wanted[of_units - 1], prepend=0)
    fits = (total == due) & (n_ids > 0)
    tokens, units = np.flatnonzero(np.repeat(fits, n_ids)), np.flatnonzero(np.repeat(fits, n_units))
    if len(units):
        ends, wanted = np.cumsum(lengths[tokens]), np.cumsum(want[units])
        at = np.searchsorted(ends, wanted)
        counts[units] = np.diff(at, prepend=-1)
        chunk = np.repeat(np.arange(len(n_units)), n_units)
        fits[chunk[units[ends[at] != wanted]]] = False
    alone = n_units == 1
    counts[of_units[alone] - 1] = n_ids[alone]
    return counts, fits | alone


@dataclass
class Encoded:
    """Token ids of a number of texts, one after the other, and how many each text has."""

    ids: np.ndarray
    counts: np.ndarray

    def take(self, places: np.ndarray) -> Encoded:
        """The tokens of the texts at these places."""
        ends, counts = np.cumsum(self.counts, dtype=np.int64), self.counts[places]
        starts = ends - self.counts
        return Encoded(self.ids[gather(starts[places], counts)], counts)

    def spell(self, raw: np.ndarray, starts: np.ndarray, want: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether the bytes of each text's tokens are ``want``, which has ``sizes`` bytes per text."""
        lengths = starts[self.ids + 1] - starts[self.ids]
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(self.counts)])]
        same = np.diff(ends) == sizes
        first = np.cumsum(sizes) - sizes
        spelled = raw[gather(starts[self.ids], lengths)]
        wrong = spelled[gather(ends[:-1][same], sizes[same])] != want[gather(first[same], sizes[same])]
        before = np.concatenate([[0], np.cumsum(wrong)])
        places = np.concatenate([[0], np.cumsum(sizes[same])])
        same[same] = np.diff(before[places]) == 0
        return same


@dataclass
class Known:
    """Units with their tokens from both tokenizers, whether these spell them, and in how many slices they have come."""

    units: pa.Array
    sides: tuple[Encoded, Encoded]
    spelled: np.ndarray
    seen: np.ndarray

    @property
    def size(self) -> int:
        return len(string_bytes(self.units)[0])

    def only(self, places: np.ndarray) -> Known:
        """The units at these places, as if they had come once."""
        a, b = (side.take(places) for side in self.sides)
        return Known(self.units.take(pa.array(places)), (a, b), self.spelled[places], np.ones(len(places), np.int32))

    def with_more(self, more: Known) -> Known:
        """These units and then ``more``."""
        sides = [
            Encoded(np.concatenate([one.ids, two.ids]), np.concatenate([one.counts, two.counts]))
            for one, two in zip(self.sides, more.sides, strict=True)
        ]
        joined = [np.concatenate(pair) for pair in ((self.spelled, more.spelled), (self.seen, more.seen))]
        return Known(pa.concat_arrays([self.units, more.units]), tuple(sides), *joined)


_loaded: dict[tuple[str, str], Tokenizers] = {}


def tokenizers_of(paths: tuple[str, str]) -> Tokenizers:
    """The tokenizers, loaded once per worker process."""
    if paths not in _loaded:
        _loaded[paths] = Tokenizers.load(*paths)
    return _loaded[paths]


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, others from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def cut(text: str) -> Iterator[str]:
    """A long text in parts of about ``SLICE`` characters, without the single spaces between them."""
    start = 0
    while len(text) - start > SLICE:
        found = SINGLE_SPACE.search(text, start + SLICE)
        if not found:
            break
        yield text[start : found.start()]
        start = found.end()
    yield text[start:]


def cuttable(raw: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Whether a single space between the characters that end at ``before`` and begin at ``after`` has no white space beside it.

    A character that may be a wider white space by its first byte counts as one.
    """
    last, first = raw[before], raw[after]
    wide = (raw[np.maximum(before - 1, 0)] == WIDE_SPACES[0]) | np.isin(raw[np.maximum(before - 2, 0)], WIDE_SPACES[1:])
    return (last > 0x20) & (first > 0x20) & ~np.isin(first, WIDE_SPACES) & ~((last >= 0x80) & wide)


def units_of(strings: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(units, units per text): texts cut at every single space that has no white space beside it.

    An empty text has no units.
    """
    raw, offsets = string_bytes(strings)
    filled = offsets[:-1] < offsets[1:]
    inside = raw == 0x20
    inside[offsets[:-1][filled]] = inside[offsets[1:][filled] - 1] = False
    spaces = np.flatnonzero(inside)
    cuts = spaces[cuttable(raw, spaces - 1, spaces + 1)]
    kept = np.ones(len(raw), bool)
    kept[cuts] = False
    ends = np.sort(np.concatenate([cuts, offsets[1:][filled]]))
    starts = np.sort(np.concatenate([cuts + 1, offsets[:-1][filled]]))
    places = np.concatenate([[0], np.cumsum(ends - starts)])
    units = pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(places), pa.py_buffer(raw[kept].tobytes()))
    return units, np.diff(np.searchsorted(cuts, offsets)) + filled


def gallop(wanted: np.ndarray, ends: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For every wanted number the first place in the ascending ``ends`` that is not below it; one must exist.

    Probes go from ``start`` up or down by 1, 2, 4, ... until the place is bracketed; then the bracket is halved.
    """
    low, high = np.full(len(wanted), -1), np.full(len(wanted), len(ends) - 1)
    upwards = ends[start] < wanted
    low[upwards], high[~upwards] = start[upwards], start[~upwards]
    searching, step = np.arange(len(wanted)), 1
    while len(searching):
        up = upwards[searching]
        probe = np.clip(start[searching] + np.where(up, step, -step), 0, len(ends) - 1)
        below = ends[probe] < wanted[searching]
        low[searching[below]] = np.maximum(low[searching[below]], probe[below])
        high[searching[~below]] = np.minimum(high[searching[~below]], probe[~below])
        edge = (probe == 0) | (probe == len(ends) - 1)
        searching = searching[(below == up) & ~edge]
        step *= 2
    open_ = np.flatnonzero(high - low > 1)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        below = ends[middle] < wanted[open_]
        low[open_[below]], high[open_[~below]] = middle[below], middle[~below]
        open_ = open_[high[open_] - low[open_] > 1]
    return high


@dataclass
class Aligned:
    """Links and groups of consecutive documents, whose tokens are numbered through."""

    links_short: np.ndarray
    links_long: np.ndarray
    cuts_short: np.ndarray
    cuts_long: np.ndarray


def intersect(short: np.ndarray, of_short: np.ndarray, long_: np.ndarray, of_long: np.ndarray) -> Aligned:
    """Align token ends that ascend over all documents; ``of_*`` are the offsets of the documents' tokens.

    In every document the last ends of both lists are equal.
    """
    n_short, n_long = np.diff(of_short), np.diff(of_long)
    inside = np.arange(len(short)) - np.repeat(of_short[:-1], n_short)
    guess = np.repeat(of_long[:-1], n_short) + inside * np.repeat(n_long, n_short) // np.repeat(n_short, n_short)
    rank = gallop(short, long_, guess)
    common = long_[rank] == short
    # A token overlaps from where the one before it ended, or just after if both lists end there, up to its own rank.
    first = np.zeros(len(short), np.int64)
    first[1:] = rank[:-1] + common[:-1]
    overlaps = rank - first + 1
    return Aligned(
        np.repeat(np.arange(len(short)), overlaps), gather(first, overlaps), np.flatnonzero(common), rank[common]
    )


def group_texts(
    a: np.ndarray, b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray, groups: np.ndarray, tools: Tokenizers
) -> list[memoryview]:
    """``a1,a2|b1;a3|b2,b3`` of every document; ``groups`` counts the groups of each."""
    last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    last_a[cuts_a], last_b[cuts_b] = 1, 1
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    first_b = np.concatenate([[0], cuts_b + 1])[:-1]
    final = np.cumsum(groups) - 1
    last_b[cuts_b[final]] = 2
    signed = np.empty(len(a) + len(b), np.int64)
    signed[np.arange(len(a)) + first_b[group_a]] = 2 * a + last_a
    signed[np.arange(len(b)) + cuts_a[group_b] + 1] = tools.first_b + 3 * b + last_b
    raw, places = string_bytes(tools.signed.take(pa.array(signed)))
    ends, held = places[cuts_a[final] + cuts_b[final] + 2].tolist(), memoryview(raw)
    return [held[s:e] for s, e in zip([0, *ends[:-1]], ends, strict=True)]


def align(strings: pa.Array, tools: Tokenizers) -> list[Alignment]:
    """The alignment of every text."""
    units, n_units = units_of(strings)
    coded = units.dictionary_encode()
    codes, distinct = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    out = [Alignment() for _ in range(len(strings))]
    if not len(distinct):
        return out
    codes = tools.places(distinct)[codes]
    sides, spelled = tools.known.sides, tools.known.spelled
    of_units = np.concatenate([[0], np.cumsum(n_units)])
    wrong = np.concatenate([[0], np.cumsum(~spelled[codes])])[of_units]
    usable = (np.diff(wrong) == 0) & (n_units > 0)
    n_a, n_b = (np.diff(np.concatenate([[0], np.cumsum(side.counts[codes])])[of_units]) for side in sides)
    size_a, size_b = tools.sizes
    for a_is_short in (True, False):
        rows = np.flatnonzero(usable & ((n_a <= n_b) == a_is_short))
        if not len(rows):
            continue
        own = codes[gather(of_units[rows], n_units[rows])]
        a, b = (side.take(own).ids.astype(np.int64) for side in sides)
        of_a, of_b = np.concatenate([[0], np.cumsum(n_a[rows])]), np.concatenate([[0], np.cumsum(n_b[rows])])
        ends_a, ends_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
        if a_is_short:
            found = intersect(ends_a, of_a, ends_b, of_b)
            linked = (a[found.links_short] << ID_BITS) | b[found.links_long]
            cuts_a, cuts_b, of_short = found.cuts_short, found.cuts_long, of_a
        else:
            found = intersect(ends_b, of_b, ends_a, of_a)
            linked = (a[found.links_long] << ID_BITS) | b[found.links_short]
            cuts_a, cuts_b, of_short = found.cuts_long, found.cuts_short, of_b
        links = np.searchsorted(found.links_short, of_short)
        groups = np.diff(np.searchsorted(found.cuts_short, of_short))
        written = group_texts(a, b, cuts_a, cuts_b, groups, tools)
        for k, r in enumerate(rows.tolist()):
            out[r] = Alignment(
                int(n_a[r]), int(n_b[r]), int(groups[k]), int(links[k + 1] - links[k]), written[k],
                linked[links[k] : links[k + 1]],
            )
    return out


@dataclass
class Alignment:
    """Tokens, groups and links of one text, its groups written out and the id pair of every link."""

    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    groups: bytes = b""
    linked: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


@dataclass
class Listed:
    """One document's row: counts, digest of its groups, and its distinct id pairs with their numbers of links."""

    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    groups_sha256: str
    pairs: np.ndarray
    times: np.ndarray


def listed(parts: Iterable[Alignment]) -> Listed:
    """The row of a document from its parts, between which both tokenizers end; one bad part leaves it without tokens."""
    total, digest, found = np.zeros(4, np.int64), hashlib.sha256(), []
    for n, part in enumerate(parts):
        if not part.n_groups:
            none = np.zeros(0, np.int64)
            return Listed(0, 0, 0, 0, "", none, none)
        total += (part.n_a, part.n_b, part.n_groups, part.n_links)
        digest.update(b";" * (n > 0) + part.groups)
        found.append(np.unique(part.linked, return_counts=True))
    pairs, times = added(found)
    return Listed(*total.tolist(), digest.hexdigest(), pairs, times.astype(np.int32))


def added(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(distinct pairs, their numbers) from several such."""
    if len(found) == 1:
        return found[0]
    pairs, places = np.unique(np.concatenate([p for p, _ in found]), return_inverse=True)
    times = np.zeros(len(pairs), np.int64)
    np.add.at(times, places, np.concatenate([t for _, t in found]))
    return pairs, times


def rows_of(strings: pa.Array, tools: Tokenizers) -> list[Listed]:
    """The rows of a slice of texts; one text above ``SLICE`` bytes stands alone in it and goes part by part."""
    if len(strings) == 1 and strings[0].as_buffer().size > SLICE:
        parts = (align(pa.array([part], pa.string()), tools)[0] for part in cut(strings[0].as_py()))
        return [listed(parts)]
    return [listed([found]) for found in align(strings, tools)]


def encode_and_list(df: DataFrame, text: str, paths: tuple[str, str], keep: list[Column], kept: str) -> DataFrame:
    """Documents with their alignment and their links as places in the list of their slice, and one row per list.

    A document has ``links``, (place, times); a list has ``pairs``, (a id, b id, times), and no document columns.
    """
    names = [f.strip().split(" ")[0] for f in kept.split(",")]
    own = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, slice long"
    links, listed = "array<struct<place:int,times:long>>", "array<struct<a:int,b:int,times:long>>"
    fields = f"{kept}, {own}, links {links}, pairs {listed}"
    link_type = pa.list_(pa.struct([("place", pa.int32()), ("times", pa.int64())]))
    pair_type = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("times", pa.int64())]))

    own_fields = [f.split()[0] for f in own.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, task, number = tokenizers_of(paths), TaskContext.get().partitionId(), 0
        parts, rows, size = [], [], 0

        def written() -> pa.RecordBatch:
            """The rows of one slice, and its list as the last row."""
            joined, times = (np.concatenate([getattr(r, c) for r in rows]) for c in ("pairs", "times"))
            offsets = np.concatenate([[0], np.cumsum([len(r.pairs) for r in rows])]).astype(np.int32)
            distinct, places = np.unique(joined, return_inverse=True)
            places = places.astype(np.int32)
            total = np.bincount(places, times, len(distinct)).astype(np.int64)
            link = pa.StructArray.from_arrays([pa.array(places), pa.array(times, pa.int64())], names=["place", "times"])
            ids = [(distinct >> ID_BITS).astype(np.int32), (distinct & ((1 << ID_BITS) - 1)).astype(np.int32)]
            pair = pa.StructArray.from_arrays([*map(pa.array, ids), pa.array(total)], names=["a", "b", "times"])
            arrays = {c: pa.concat_arrays([p.column(c) for p in parts]) for c in names}
            arrays |= {c: pa.array([getattr(r, c) for r in rows]) for c in own_fields[:-1]}
            arrays |= {"links": pa.ListArray.from_arrays(pa.array(offsets), link).cast(link_type)}
            arrays = {c: pa.concat_arrays([a, pa.nulls(1, a.type)]) for c, a in arrays.items()}
            arrays["slice"] = pa.array([(task << 32) | number] * (len(rows) + 1), pa.int64())
            whole = pa.ListArray.from_arrays(pa.array([0, len(distinct)], pa.int32()), pair).cast(pair_type)
            arrays["pairs"] = pa.concat_arrays([pa.nulls(len(rows), pair_type), whole])
            order = [*names, *own_fields, "links", "pairs"]
            return pa.RecordBatch.from_arrays([arrays[c] for c in order], names=order)

        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                strings = texts(part, "_text")
                rows += rows_of(strings, tools)
                pa.default_memory_pool().release_unused()
                parts.append(part.select(names))
                size += len(string_bytes(strings)[0])
                if size >= LISTED:
                    yield written()
                    parts, rows, size, number = [], [], 0, number + 1
        if rows:
            yield written()
        tools.known = None
        release_memory()

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, fields)


def pair_scores(lists: DataFrame) -> DataFrame:
    """(a, b, total, best): links of every id pair in the corpus, and whether no id is linked to b more often."""
    counted = lists.groupBy("a", "b").agg(F.sum("times").alias("total"))
    most = counted.groupBy("b").agg(F.max("total").alias("most"))
    return counted.join(most, "b").select("a", "b", "total", (F.col("total") == F.col("most")).alias("best"))


def alignments(df: DataFrame, text: str, paths: tuple[str, str], keep: list[Column], kept: str) -> DataFrame:
    """``keep`` columns with n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256, a row per row of ``df``.

    ``paths`` are a byte-level vocabulary and a piece vocabulary that puts a space before each text.
    """
    names = [f.strip().split(" ")[0] for f in kept.split(",")]
    encoded = materialise(encode_and_list(df, text, paths, keep, kept), "aligned")
    lists = encoded.where("pairs IS NOT NULL").select("slice", F.posexplode("pairs").alias("place", "pair"))
    lists = lists.select("slice", "place", "pair.*")
    scored = materialise(pair_scores(lists), "pair-scores")
    # One row per slice and distinct pair; AQE splits the pairs that all slices hold, against one row of ``scored`` each.
    per_slice = lists.join(scored, ["a", "b"]).groupBy("slice").agg(
        F.sort_array(F.collect_list(F.struct("place", "total", "best"))).alias("scores")
    )
    docs = encoded.where("pairs IS NULL").drop("pairs").join(per_slice, "slice", "left")
    zero = F.lit(0).cast("long")

    def total(value) -> Column:
        return F.coalesce(
            F.aggregate("links", zero, lambda sum_, link: sum_ + value(link["times"], F.get("scores", link["place"]))), zero
        )

    return docs.select(
        *names, "n_a", "n_b", "n_groups", "n_links",
        total(lambda times, score: F.when(score["best"], times).otherwise(0)).alias("n_best"),
        total(lambda times, score: times * score["total"]).alias("count_sum"),
        "groups_sha256",
    )
