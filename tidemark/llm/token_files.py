"""Token ids in a binary file format: ids ranked by frequency, byte-aligned lengths in control bytes of their own.

A file is a Parquet file of blocks, so any Hadoop file system holds it and Spark's committer guards the write. A block
holds whole documents. Its ids are replaced by their rank in the corpus (the most frequent id is 0) and stored in one to
four little-endian bytes each; the lengths go, four to a byte, into a separate ``control`` string. The reader looks up
the four lengths of every control byte in a table of 256 rows and gathers all ids of the block at once.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import coded_words, gather, slices, texts
from tidemark.session import fresh_dir

BLOCK_IDS = 1 << 18
# Distinct words are looked up once per slice, so larger slices look up fewer.
SLICE = 24 << 20
KNOWN = 16 << 20  # bytes of words, with 8 more for each, whose ids a worker keeps from slice to slice
BLOCK = (
    "shard int, block int, start long, doc_ids array<long>, n_tokens array<long>, control binary, data binary"
)

# Row c: how many bytes each of the four ids under control byte c takes.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.int64) + 1


def encode_block(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of ranks below 2**32."""
    ranks = ranks.astype("<u4", copy=False)
    spare = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    raw, most = ranks.view(np.uint8).reshape(-1, 4), int(ranks.max(initial=0))
    for limit in (0xFF, 0xFFFF, 0xFFFFFF):
        if most > limit:
            spare[: len(ranks)] += ranks > limit
    control = spare[0::4] | spare[1::4] << 2 | spare[2::4] << 4 | spare[3::4] << 6
    width = int(spare.max(initial=0)) + 1
    taken = np.arange(width, dtype=np.uint8) <= spare[: len(ranks), None]
    return control.tobytes(), raw[:, :width][taken].tobytes()


def decode_block(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks that ``encode_block`` has written."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    starts = np.cumsum(lengths) - lengths
    padded = np.frombuffer(data + b"\0\0\0", np.uint8)
    ranks = padded[starts].astype(np.uint32)
    for byte in range(1, int(lengths.max(initial=1))):
        longer = np.flatnonzero(lengths > byte)
        ranks[longer] |= padded[starts[longer] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return ranks


COUNTS = -1  # stands for the shard in the rows that hold counts

# Words of Latin letters alone, which the word-level BPE encodes as one unit, and one mark after them.
PLAIN_WORD = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+[.,]?$"
MARKS = (".", ",")


@dataclass
class Known:
    """Distinct words with the ids of all, the number of ids of each, and in how many slices each has come."""

    words: pa.Array
    ids: np.ndarray
    counts: np.ndarray
    seen: np.ndarray

    @classmethod
    def none(cls) -> Known:
        return cls(pa.array([], pa.large_string()), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32))

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.counts) - self.counts

    def with_more(self, words: pa.Array, ids: np.ndarray, counts: np.ndarray) -> Known:
        """These words and then the given ones, which have come once."""
        seen = np.concatenate([self.seen, np.ones(len(words), np.int32)])
        joined = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts])
        return Known(pa.concat_arrays([self.words, words]), *joined, seen)

    def bounded(self) -> Known:
        """All words up to ``KNOWN`` bytes; of more only those that have come again, or none."""
        if self.words.nbytes <= KNOWN:
            return self
        often = np.flatnonzero(self.seen > 1)
        words, counts = self.words.take(pa.array(often)), self.counts[often]
        if 2 * words.nbytes > KNOWN:
            return Known.none()
        return Known.none().with_more(words, self.ids[gather(self.starts[often], counts)], counts)


class WordEncoder:
    """Ids of whole texts, with every distinct word of a slice encoded once, or not at all while its ids are kept.

    Right for a lower-casing tokenizer whose pieces never contain white space, whose units never depend on neighbouring
    words, and whose last piece of a unit ends in ``</w>``; white space itself gives no ids. ``tests/llm`` holds it
    against encoding whole texts.
    """

    CHUNK = 1000

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer, pre_tokenizers

        # Tasks run side by side already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.end_id, self.known = Tokenizer.from_file(path), end_id, Known.none()
        # The same model behind a bare split at spaces: all that plain words need.
        self.bare = Tokenizer(self.tokenizer.model)
        units = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), units])
        vocabulary = self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.marks = [self.tokenizer.encode(m, add_special_tokens=False).ids for m in MARKS]

    def plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each) of lower-case words that are one unit each."""
        parts = [words[at : at + self.CHUNK] for at in range(0, len(words), self.CHUNK)]
        found = [self.bare.encode_batch_fast([" ".join(p)], add_special_tokens=False)[0].ids for p in parts]
        ids = np.concatenate([np.array(f, np.int64) for f in found]) if found else np.zeros(0, np.int64)
        return ids, np.diff(np.flatnonzero(self.last[ids]), prepend=-1)

    def other(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for any words without white space; their ids are told apart by the places of the pieces."""
        ids, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), self.CHUNK):
            part = words[at : at + self.CHUNK]
            encoding = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ends = np.cumsum([len(w) + 1 for w in part])
            places = np.fromiter((o[0] for o in encoding.offsets), np.int64, len(encoding.ids))
            ids.append(np.array(encoding.ids, np.int64))
            counts.append(np.bincount(np.searchsorted(ends, places, "right"), minlength=len(part)))
        return np.concatenate(ids), np.concatenate(counts)

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all distinct words, number of ids of each)."""
        plain = pc.match_substring_regex(words, PLAIN_WORD)
        simple = words.filter(plain)
        marks = [pc.ends_with(simple, m).to_numpy(zero_copy_only=False) for m in MARKS]
        bases = pc.utf8_lower(pc.utf8_rtrim(simple, "".join(MARKS))).dictionary_encode()
        ids, sizes = self.plain(bases.dictionary.to_pylist())
        odd_ids, odd_sizes = self.other(words.filter(pc.invert(plain)).to_pylist())
        mark_ids = [np.array(m, np.int64) for m in self.marks]
        pool = np.concatenate([ids, odd_ids, *mark_ids]).astype(np.int32)
        chosen, plain = bases.indices.to_numpy(zero_copy_only=False), plain.to_numpy(zero_copy_only=False)
        # Every word is a run of the pool, and after it the run of its mark, which may be empty.
        starts, counts = np.zeros((len(words), 2), np.int64), np.zeros((len(words), 2), np.int64)
        starts[plain, 0], counts[plain, 0] = (np.cumsum(sizes) - sizes)[chosen], sizes[chosen]
        starts[~plain, 0], counts[~plain, 0] = len(ids) + np.cumsum(odd_sizes) - odd_sizes, odd_sizes
        at = len(ids) + len(odd_ids)
        for mask, own in zip(marks, mark_ids, strict=True):
            rows = np.flatnonzero(plain)[mask]
            starts[rows, 1], counts[rows, 1] = at, len(own)
            at += len(own)
        return pool[gather(starts.reshape(-1), counts.reshape(-1))], counts.sum(axis=1)

    def places(self, words: pa.Array) -> np.ndarray:
        """Where distinct words stand in ``known``, after those that it did not hold are encoded."""
        found = pc.index_in(words, value_set=self.known.words)
        new = found.is_null()
        places, fresh = pc.fill_null(found, 0).to_numpy().astype(np.int64), new.to_numpy(zero_copy_only=False)
        self.known.seen[places[~fresh]] += 1
        if fresh.any():
            places[fresh] = len(self.known.words) + np.arange(fresh.sum())
            more = words.filter(new)
            self.known = self.known.with_more(more, *self.words(more))
        return places

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts with the end id after each, number of ids of each text)."""
        offsets, codes, distinct = coded_words(pc.ascii_split_whitespace(column))
        places = self.places(distinct.cast(pa.large_string()))[codes]
        per_word = self.known.counts[places]
        flat = self.known.ids[gather(self.known.starts[places], per_word)]
        self.known = self.known.bounded()
        before = np.concatenate([[0], np.cumsum(per_word)])
        per_text = before[offsets[1:]] - before[offsets[:-1]]
        with_end = np.full(len(flat) + len(per_text), self.end_id, np.int32)
        body = np.ones(len(with_end), bool)
        body[np.cumsum(per_text + 1) - 1] = False
        with_end[body] = flat
        return with_end, per_text + 1


_loaded: dict[tuple[str, int], WordEncoder] = {}


def word_encoder(path: str, end_id: int) -> WordEncoder:
    """The encoder, loaded once per worker process."""
    if (path, end_id) not in _loaded:
        _loaded[path, end_id] = WordEncoder(path, end_id)
    return _loaded[path, end_id]


def write_ids(df: DataFrame, key: str, text: str, encoder: Callable[[], WordEncoder], path: str) -> None:
    """Blocks of plain ids (no control bytes yet) in ascending order of the key.

    Equal keys are ordered by a hash of the text, NULL keys come first. Texts are tokenised here and nowhere else; a task
    also leaves a row with its counts of all ids. Range partitions over key and hash stay even when keys repeat.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        start = block = 0
        total = np.zeros(len(encode.last), np.int64)
        for batch in batches:
            for part in slices(batch, text, SLICE):
                ids, sizes = encode(texts(part, text))
                ends = np.cumsum(sizes)
                total += np.bincount(ids, minlength=len(total))
                shard, keys = part.column("_shard")[0].as_py(), part.column(key)
                first = 0
                while first < len(sizes):
                    done = int(ends[first - 1]) if first else 0
                    last = max(first + 1, int(np.searchsorted(ends, done + BLOCK_IDS, "right")))
                    data = ids[done : int(ends[last - 1])].astype(encode.dtype).tobytes()
                    own = keys.slice(first, last - first).to_pylist()
                    yield _row(shard, block, start, own, sizes[first:last].tolist(), None, data)
                    start += int(ends[last - 1]) - done
                    block, first = block + 1, last
        seen = np.flatnonzero(total)
        yield _row(COUNTS, 0, 0, seen.tolist(), total[seen].tolist(), None, None)

    ordered = df.select(F.col(key).cast("long").alias(key), text).withColumn("_tie", F.xxhash64(text))
    ordered = ordered.repartitionByRange(key, "_tie").sortWithinPartitions(key, "_tie")
    placed = ordered.select(key, text, F.spark_partition_id().alias("_shard"))
    placed.mapInArrow(blocks, BLOCK).write.option("compression", "zstd").parquet(path)


def _row(*values) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
    arrays = [pa.array([v], t) for v, t in zip(values, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in BLOCK.split(", ")])


def id_counts(stored: DataFrame) -> DataFrame:
    """(id, n) over all texts, from the counts that every task has left beside its blocks."""
    pairs = F.explode(F.arrays_zip("doc_ids", "n_tokens")).alias("p")
    rows = stored.where(F.col("shard") == COUNTS).select(pairs)
    return rows.groupBy(F.col("p.doc_ids").alias("id")).agg(F.sum("p.n_tokens").alias("n"))


def plain_ids(data: bytes, n: int) -> np.ndarray:
    """The ids of a block without control bytes, two or four bytes each."""
    return np.frombuffer(data, f"<u{len(data) // n}") if n else np.zeros(0, "<u4")


def held() -> Column:
    """How many ids a block holds."""
    return F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, b: a + b)


def rank_ids(counts: DataFrame) -> np.ndarray:
    """ids in order of falling frequency. One number per id of the vocabulary comes to the driver, a fixed bound."""
    rows = counts.toPandas().sort_values(["n", "id"], ascending=[False, True])
    return rows["id"].to_numpy(np.int64)


def write_ranked(stored: DataFrame, by_rank: np.ndarray, path: str) -> None:
    """The blocks again with ranks for ids; a folder per shard, (shard, block) is the order of the keys."""

    def recode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.zeros(int(by_rank.max(initial=0)) + 1, "<u4")
        rank[by_rank] = np.arange(len(by_rank))
        for batch in batches:
            for row in batch.to_pylist():
                row["control"], row["data"] = encode_block(rank[plain_ids(row["data"], sum(row["n_tokens"]))])
                yield _row(*row.values())

    stored.mapInArrow(recode, BLOCK).write.option("compression", "zstd").partitionBy("shard").parquet(path)


def read_tokens(spark, path: str, by_rank: np.ndarray, digest: Callable, schema: str) -> DataFrame:
    """``digest(key, start, ids)`` of every document in the files; start counts all ids of earlier documents.

    Offsets of the files come from one sum per file, so the window over them is bounded by the number of files.
    """
    stored = spark.read.schema(BLOCK).parquet(path)
    sizes = stored.groupBy("shard").agg(F.sum(held()).alias("_held"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_before"))
    placed = stored.join(F.broadcast(offsets), "shard").withColumn("start", F.col("start") + F.col("_before"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = by_rank[decode_block(row["control"], row["data"], sum(row["n_tokens"]))]
                yield digest(row["doc_ids"], row["start"], np.array(row["n_tokens"], np.int64), ids)

    columns = ["start", "doc_ids", "n_tokens", "control", "data"]
    return placed.select(*columns).mapInArrow(decode, schema)


def crc_digest(keys: list, start: int, sizes: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian 32-bit numbers."""
    raw, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(sizes)
    sums = [zlib.crc32(raw[4 * int(e - n) : 4 * int(e)]) for e, n in zip(ends, sizes, strict=True)]
    columns = [pa.array(keys, pa.int64()), pa.array(start + ends - sizes), pa.array(sizes), pa.array(sums, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])


def token_files(df: DataFrame, key: str, text: str, tokenizer_path: str, end_id: int) -> DataFrame:
    """Encode, write and read back: one row per document with its place and the checksum of its ids.

    NULL texts are empty and hold the end id only; repeated rows are stored as often as they come; NULL keys come
    first; an empty table gives no rows; other columns of ``df`` are not looked at, whatever their names.
    """
    spark = df.sparkSession
    plain, ranked = fresh_dir(spark, "ids"), fresh_dir(spark, "tokens")
    write_ids(df, key, text, lambda: word_encoder(tokenizer_path, end_id), plain)
    stored = spark.read.schema(BLOCK).parquet(plain)
    by_rank = rank_ids(id_counts(stored))
    write_ranked(stored.where(F.col("shard") != COUNTS), by_rank, ranked)
    return read_tokens(spark, ranked, by_rank, crc_digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
