"""SentencePiece encoding and decoding as a batched Viterbi search in numpy.

Words of equal byte length advance together: the hashes of all their substrings come from prefix hashes, sorted piece
keys are probed once per substring length, and one maximum per position stores the best score and its backpointer.

A text is taken as it is, without Unicode normalisation: a space becomes the word mark of the vocabulary, a mark is put
before the text, and what no piece covers falls back to byte pieces, so decoding gives back every text exactly. Inside
the search the mark is the byte 0xFF, which UTF-8 never holds; a literal mark character in a text is spelled in bytes.

The vocabulary file ranks its pieces by frequency and holds no probabilities, so a piece gets the log probability that
Zipf's law gives its rank, and the search maximises their sum.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import FNV_PRIME, coded_words, gather, mix, powers, slices, string_bytes, texts

MARK, SPELLED_MARK = 0xFF, "▁".encode()
BYTE_SCORE = -40.0
UNUSABLE = -1e8  # the vocabulary's own sign for pieces that are never chosen
TOGETHER, CELLS = 48, 1 << 21  # longest word that is searched in a batch; score cells of a batch
NEVER = np.float32(-1e9)


@dataclass
class Vocabulary:
    """Sorted piece hashes with ids and scores, and the bytes of every id for decoding."""

    keys: np.ndarray
    ids: np.ndarray
    scores: np.ndarray
    lengths: np.ndarray
    first_byte: int
    raw: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        spelled, usable, ranks = [], [], []
        for i in range(model.get_piece_size()):
            plain = not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
            piece = model.id_to_piece(i).encode()
            if model.is_byte(i):
                spelled.append(bytes([int(piece[3:5], 16)]))
            else:
                spelled.append(piece.replace(SPELLED_MARK, bytes([MARK])) if plain else b"")
            # A mark inside a piece would cross words.
            if plain and model.get_score(i) > UNUSABLE and spelled[-1].rfind(bytes([MARK])) <= 0:
                usable.append(i)
                ranks.append(-model.get_score(i))
        rank = np.array(ranks) - min(ranks)
        scores = -np.log(rank + 2.0)
        keys = np.array([hash_bytes(np.frombuffer(spelled[i], np.uint8)) for i in usable], np.uint64)
        order = np.argsort(keys)
        sizes = np.array([len(s) for s in spelled], np.int64)
        return cls(
            keys[order], np.array(usable)[order], scores[order].astype(np.float32),
            np.unique([len(spelled[i]) for i in usable]), model.piece_to_id("<0x00>"),
            np.frombuffer(b"".join(spelled), np.uint8), np.cumsum(sizes) - sizes, sizes,
        )

    def probe(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids) of the pieces with these hashes; NEVER where there is none."""
        place = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        hit = self.keys[place] == hashes
        return np.where(hit, self.scores[place], NEVER), self.ids[place]


def prefix_hashes(rows: np.ndarray) -> np.ndarray:
    """Hashes of all prefixes of the rows of a byte matrix: h(0) = 0, h(i + 1) = h(i) * prime + scrambled byte."""
    out = np.zeros((rows.shape[0], rows.shape[1] + 1), np.uint64)
    scrambled = mix(np.arange(1, 257, dtype=np.uint64))[rows]
    for i in range(rows.shape[1]):
        out[:, i + 1] = out[:, i] * np.uint64(FNV_PRIME) + scrambled[:, i]
    return out


def hash_bytes(raw: np.ndarray) -> int:
    return int(prefix_hashes(raw[None, :])[0, -1])


def search(rows: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids of the best path of every row one after the other, number of ids of each row) of equally long words."""
    n, length = rows.shape
    longest = int(min(vocabulary.lengths.max(), length))
    prefixes, power = prefix_hashes(rows), powers(FNV_PRIME, longest + 1)
    # Cell (row, end, k): the piece of length k that ends at ``end``.
    score = np.full((n, length + 1, longest + 1), NEVER, np.float32)
    piece = np.zeros((n, length + 1, longest + 1), np.int32)
    for k in vocabulary.lengths[vocabulary.lengths <= longest]:
        hashes = prefixes[:, k:] - prefixes[:, :-k] * power[k]
        score[:, k:, k], piece[:, k:, k] = vocabulary.probe(hashes)
    single = score[:, 1:, 1] <= NEVER
    score[:, 1:, 1][single] = BYTE_SCORE
    piece[:, 1:, 1][single] = rows[single].astype(np.int32) + vocabulary.first_byte
    best = np.full((n, longest + length + 1), NEVER * 2, np.float32)  # position p stands in column longest + p
    best[:, longest] = 0
    back = np.zeros((n, length + 1), np.int32)
    every = np.arange(n)
    for end in range(1, length + 1):
        reached = best[:, end : end + longest + 1][:, ::-1] + score[:, end]
        reached[:, 0] = NEVER * 4
        back[:, end] = reached.argmax(axis=1)
        best[:, longest + end] = reached[every, back[:, end]]
    path, at = np.full((n, length), -1, np.int64), np.full(n, length)
    for step in range(length - 1, -1, -1):
        on = at > 0
        k = back[every, at]
        path[on, step] = piece[every, at, k][on]
        at = np.where(on, at - k, 0)
        if not at.any():
            break
    chosen = path >= 0
    return path[chosen], chosen.sum(axis=1)


def search_long(row: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """The best path of one very long word: substrings are probed at all positions at once, then one pass over hits."""
    length = len(row)
    prefixes, power = prefix_hashes(row[None, :])[0], powers(FNV_PRIME, int(vocabulary.lengths.max()) + 1)
    edges: list[list[tuple[int, float, int]]] = [[] for _ in range(length + 1)]
    for k in vocabulary.lengths[vocabulary.lengths <= length].tolist():
        scores, ids = vocabulary.probe(prefixes[k:] - prefixes[:-k] * power[k])
        for at in np.flatnonzero(scores > NEVER).tolist():
            edges[at + k].append((k, float(scores[at]), int(ids[at])))
    best, back = [0.0] * (length + 1), [(0, 0)] * (length + 1)
    for end in range(1, length + 1):
        hits = edges[end]
        if not hits or hits[0][0] != 1:
            hits = [(1, BYTE_SCORE, int(row[end - 1]) + vocabulary.first_byte), *hits]
        # The shortest piece wins a tie, as the first maximum does in a batch.
        top = max(hits, key=lambda e: best[end - e[0]] + e[1])
        best[end], back[end] = best[end - top[0]] + top[1], (top[0], top[2])
    path, at = [], length
    while at:
        path.append(back[at][1])
        at -= back[at][0]
    return np.array(path[::-1], np.int64)


def encode_words(words: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words one after the other, number of ids of each); every word gets the mark in front."""
    raw, offsets = string_bytes(words)
    sizes = np.diff(offsets)
    counts, found = np.zeros(len(sizes), np.int64), []
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        longest = int(min(vocabulary.lengths.max(), size + 1))
        block = max(1, CELLS // ((size + 2) * (longest + 1)))
        for at in range(0, len(rows), block):
            part = rows[at : at + block]
            matrix = np.full((len(part), size + 1), MARK, np.uint8)
            matrix[:, 1:] = raw[offsets[part][:, None] + np.arange(size)]
            if size <= TOGETHER:
                ids, counts[part] = search(matrix, vocabulary)
                found.append((part, ids))
            else:
                for row, own in zip(part, matrix, strict=True):
                    ids = search_long(own, vocabulary)
                    counts[row] = len(ids)
                    found.append((np.array([row]), ids))
    begins, out = np.cumsum(counts) - counts, np.zeros(int(counts.sum()), np.int64)
    for part, ids in found:
        out[gather(begins[part], counts[part])] = ids
    return out, counts


def encode(column: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after the other, number of ids of each). An empty text has no ids."""
    offsets, codes, distinct = coded_words(pc.split_pattern(column, " "), keep_empty=True)
    ids, counts = encode_words(distinct, vocabulary)
    empty = pc.binary_length(column).to_numpy(zero_copy_only=False) == 0
    per_word = counts[codes] * np.repeat(~empty, np.diff(offsets))
    flat = ids[gather((np.cumsum(counts) - counts)[codes], per_word)]
    before = np.concatenate([[0], np.cumsum(per_word)])
    return flat, before[offsets[1:]] - before[offsets[:-1]]


def decode(ids: np.ndarray, counts: np.ndarray, vocabulary: Vocabulary) -> list[bytes]:
    """The UTF-8 bytes of every text, by one gather over the bytes of all pieces."""
    sizes = vocabulary.sizes[ids]
    raw = vocabulary.raw[gather(vocabulary.starts[ids], sizes)]
    raw = np.where(raw == MARK, np.uint8(32), raw).astype(np.uint8).tobytes()
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
    return [raw[int(a) + 1 : int(b)] for a, b in zip(ends[:-1], ends[1:], strict=True)]


_loaded: dict[str, Vocabulary] = {}


def vocabulary_of(path: str) -> Vocabulary:
    """The vocabulary, loaded once per worker process."""
    if path not in _loaded:
        _loaded[path] = Vocabulary.load(path)
    return _loaded[path]


def with_ids(df: DataFrame, text: str, path: str, keep: list[Column], kept: str) -> DataFrame:
    """``keep`` columns with ``ids``, the piece ids of the text; NULL texts are empty."""
    names = [f.strip().split(" ")[0] for f in kept.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(path)
        for batch in batches:
            for part in slices(batch, "_text"):
                ids, counts = encode(texts(part, "_text"), vocabulary)
                places = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(places), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], lists], names=[*names, "ids"])

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, f"{kept}, ids array<int>")


def with_text(df: DataFrame, ids: str, path: str, keep: list[Column], kept: str) -> DataFrame:
    """``keep`` columns with ``text``, decoded from the ids; NULL ids give an empty text."""
    names = [f.strip().split(" ")[0] for f in kept.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(path)
        for batch in batches:
            lists = batch.column("_ids")
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            decoded = pa.array(decode(flat, counts, vocabulary), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], decoded], names=[*names, "text"])

    return df.select(*keep, F.col(ids).alias("_ids")).mapInArrow(run, f"{kept}, text string")


def round_trip(df: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """Encode every text, decode its ids, and describe both: one row per row of ``df``.

    n_pieces, n_byte_pieces (pieces that stand for one byte), ids_crc32 (ids as little-endian 32-bit numbers),
    decoded_sha256 and ``same`` (whether decoding gave back the text; a NULL text counts as empty). Repeated rows and
    rows without a key are described each; an empty table gives no rows; other columns of ``df`` are not looked at,
    whatever their names.
    """
    fields = "doc_id long, n_pieces long, n_byte_pieces long, ids_crc32 long, decoded_sha256 string, same boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(path)
        for batch in batches:
            for part in slices(batch, text):
                column = texts(part, text)
                ids, counts = encode(column, vocabulary)
                back, ends = decode(ids, counts, vocabulary), np.cumsum(counts)
                raw = memoryview(ids.astype("<u4").tobytes())
                bytewise = (ids >= vocabulary.first_byte) & (ids < vocabulary.first_byte + 256)
                before = np.concatenate([[0], np.cumsum(bytewise)])
                held = column.cast(pa.binary()).to_pylist()
                spans = zip(ends.tolist(), counts.tolist(), strict=True)
                columns = [
                    part.column(key),
                    pa.array(counts),
                    pa.array(before[ends] - before[ends - counts]),
                    pa.array([zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in spans], pa.int64()),
                    pa.array([hashlib.sha256(b).hexdigest() for b in back], pa.string()),
                    pa.array([a == b for a, b in zip(back, held, strict=True)], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in fields.split(", ")])

    return df.select(F.col(key).cast("long").alias(key), text).mapInArrow(run, fields)
