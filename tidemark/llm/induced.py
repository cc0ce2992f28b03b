"""Suffix order by induced sorting with bucket queues that spill to disk.

The order of all suffixes follows from the order of the leftmost S-type ones (LMS): scanning suffixes in ascending order,
each puts the suffix that begins one place earlier, if that is L-type, at the end of the queue of its first character;
scanning back in descending order does the same for S-type suffixes. The queues are a priority queue over the first
character that is first-in-first-out within a character, and they hold their tuples in files once they outgrow memory.

The LMS suffixes themselves are ordered by inducing once from their text order, which sorts LMS substrings, naming equal
substrings alike, and ordering the shorter string of names: by prefix doubling, as names are too many for buckets.
"""

from __future__ import annotations

import os
import shutil
import tempfile

import numpy as np

from tidemark.llm.common import mix, powers

BASE = 0x9E3779B97F4A7C15  # odd, so that its powers can be undone modulo 2**64
SPILL = 1 << 22  # positions that all queues of a pass keep in memory
BATCH = 1 << 20  # positions that are induced at a time


class Queues:
    """One first-in-first-out queue of positions per character."""

    def __init__(self, characters: int, folder: str, spill: int):
        self.held = [[] for _ in range(characters)]
        self.on_disk = [0] * characters
        self.folder, self.spill, self.in_memory = folder, spill, 0

    def _path(self, c: int) -> str:
        return f"{self.folder}/{id(self)}-{c}"

    def push(self, c: int, positions: np.ndarray) -> None:
        self.held[c].append(positions)
        self.in_memory += len(positions)
        if self.in_memory > self.spill:
            for character, parts in enumerate(self.held):
                if parts:
                    with open(self._path(character), "ab") as file:
                        for part in parts:
                            self.on_disk[character] += len(part)
                            part.astype(np.int64).tofile(file)
                    self.held[character] = []
            self.in_memory = 0

    def spread(self, characters: np.ndarray, positions: np.ndarray) -> None:
        """Push every position to the queue of its character, keeping the order."""
        if not len(positions):
            return
        order = np.argsort(characters.astype(np.uint16), kind="stable")
        sorted_characters, positions = characters[order], positions[order]
        cuts = np.flatnonzero(np.diff(sorted_characters)) + 1
        for part, at in zip(np.split(positions, cuts), [0, *cuts.tolist()], strict=True):
            self.push(int(sorted_characters[at]), part)

    def __len__(self) -> int:
        return sum(self.on_disk) + self.in_memory

    def drain(self, c: int):
        """Take what the queue holds, also what arrives meanwhile, in batches."""
        while self.on_disk[c] or self.held[c]:
            if self.on_disk[c]:
                path, n = self._path(c), self.on_disk[c]
                taken = f"{path}.taken"
                os.replace(path, taken)
                self.on_disk[c] = 0
                later, self.held[c] = self.held[c], []
                self.in_memory -= sum(len(p) for p in later)
                with open(taken, "rb") as file:
                    for at in range(0, n, BATCH):
                        yield np.fromfile(file, np.int64, min(BATCH, n - at))
                os.remove(taken)
                # What stood behind the file goes out before what has arrived since.
                for part in later:
                    yield part
            else:
                parts, self.held[c] = self.held[c], []
                self.in_memory -= sum(len(p) for p in parts)
                yield np.concatenate(parts) if len(parts) > 1 else parts[0]

    def whole(self, c: int) -> np.ndarray:
        parts = list(self.drain(c))
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def s_types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it. The last character must be the smallest and unique."""
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int32)))
    decides = np.where(step != 0, np.arange(n - 1), n)
    decides = np.minimum.accumulate(decides[::-1])[::-1]
    types = np.ones(n, bool)
    types[:-1] = np.append(step, 1)[np.minimum(decides, n - 1)] > 0
    return types


def induce(text: np.ndarray, types: np.ndarray, seeds: np.ndarray, characters: int, folder: str, spill: int):
    """Batches of all positions in suffix order, given LMS positions of which each character's are in suffix order."""
    n = len(text)
    waiting = Queues(characters, folder, spill)
    waiting.spread(text[seeds], seeds)
    larger, l_sorted = Queues(characters, folder, spill), Queues(characters, folder, spill)

    def before(positions: np.ndarray, s_type: bool) -> np.ndarray:
        earlier = positions[positions > 0] - 1
        return earlier[types[earlier] == s_type]

    for c in range(characters):
        for batch in larger.drain(c):
            l_sorted.push(c, batch)
            earlier = before(batch, False)
            larger.spread(text[earlier], earlier)
        for batch in waiting.drain(c):
            earlier = before(batch, False)
            larger.spread(text[earlier], earlier)
    smaller, s_sorted, l_out = Queues(characters, folder, spill), Queues(characters, folder, spill), {}
    smaller.push(int(text[n - 1]), np.array([n - 1]))
    for c in range(characters - 1, -1, -1):
        for batch in smaller.drain(c):
            s_sorted.push(c, batch)
            earlier = before(batch, True)
            smaller.spread(text[earlier], earlier)
        own = l_sorted.whole(c)
        for at in range(len(own), 0, -BATCH):
            earlier = before(own[max(0, at - BATCH) : at][::-1], True)
            smaller.spread(text[earlier], earlier)
        if len(own):
            l_out[c] = f"{folder}/l-{c}"
            own.tofile(l_out[c])
    for c in range(characters):
        if c in l_out:
            with open(l_out[c], "rb") as file:
                while len(part := np.fromfile(file, np.int64, BATCH)):
                    yield part
            os.remove(l_out[c])
        last = s_sorted.whole(c)
        if len(last):
            yield last[::-1]


def names_of(text: np.ndarray, ordered: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """A rank for every LMS position in ``ordered``; equal LMS substrings share it."""
    weights, back = powers(BASE, len(text)), powers(pow(BASE, -1, 1 << 64), len(text))
    terms = mix(np.arange(1 << 16, dtype=np.uint64))[text] * weights
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    ends = np.append(lms[1:] + 1, len(text))[np.searchsorted(lms, ordered)]
    value = (sums[ends] - sums[ordered]) * back[ordered]
    length = ends - ordered
    new = np.ones(len(ordered), np.int64)
    new[1:] = (value[1:] != value[:-1]) | (length[1:] != length[:-1])
    return np.cumsum(new)


def order_by_doubling(names: np.ndarray) -> np.ndarray:
    """The suffix order of a string of positive numbers."""
    n, rank, reach = len(names), names.astype(np.int64), 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(n - reach, 0)] = rank[reach:]
        order = np.argsort(rank * (n + 2) + after, kind="stable")
        key = (rank * (n + 2) + after)[order]
        fresh = np.empty(n, np.int64)
        fresh[order] = np.cumsum(np.append(1, (key[1:] != key[:-1]).astype(np.int64)))
        rank, reach = fresh, reach * 2
        if n == 0 or rank.max() == n or reach >= n:
            return order


def suffix_batches(text: np.ndarray, characters: int, spill: int = SPILL):
    """All positions of the text in suffix order, in batches. The text must end in its only 0."""
    folder = tempfile.mkdtemp(prefix="suffixes-")
    try:
        types = s_types(text)
        lms = np.flatnonzero(types[1:] & ~types[:-1]) + 1
        is_lms = np.zeros(len(text), bool)
        is_lms[lms] = True
        parts = [b[is_lms[b]] for b in induce(text, types, lms, characters, folder, spill)]
        ordered = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        if len(ordered) > 1:
            rank = names_of(text, ordered, lms)
            if rank[-1] < len(ordered):
                in_text = np.empty(len(lms), np.int64)
                in_text[np.searchsorted(lms, ordered)] = rank
                ordered = lms[order_by_doubling(in_text)]
        yield from induce(text, types, ordered, characters, folder, spill)
    finally:
        shutil.rmtree(folder, ignore_errors=True)
