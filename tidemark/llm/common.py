"""Parts that the corpus operators share: folds, byte-bounded slices of Arrow batches, and words as codes."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

# A task works on this much text at a time, whatever the size of an Arrow batch; one longer document is a slice alone.
SLICE_BYTES = 4 << 20

FNV_PRIME = 0x100000001B3

# Rows are picked by a bit map of this many bits before a join; with more keys than bits more rows pass, none is lost.
BITS = 1 << 20


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; NULL keys fall in no fold."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where the body uses it inside another lambda."""
    return F.transform(F.array(value), body)[0]


def picked_by(keys: DataFrame):
    """A function of a key column: false only for keys that are not in the one column of ``keys``.

    The bit map has a fixed size, so it goes to the tasks whatever the number of keys; an exact join follows it. Tasks
    set the bits, and the driver gets 64 of them in a row.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(BITS))
    bit = place(F.col(keys.columns[0]))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))
    found = keys.groupBy(F.floor(bit / 64).cast("int").alias("word")).agg(F.bit_or(mask).alias("bits")).toArrow()
    words = np.zeros(BITS // 64, np.uint64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)

    @F.pandas_udf("boolean")
    def test(bit: pd.Series) -> pd.Series:
        places = bit.to_numpy(np.uint64)
        return pd.Series((words[places >> np.uint64(6)] >> (places & np.uint64(63)) & np.uint64(1)).astype(bool))

    return lambda key: test(place(key))


def without_keys(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose key is not in the one column of ``keys``; only possible matches are shuffled."""
    picked = F.coalesce(picked_by(keys)(F.col(key)), F.lit(False))
    own = keys.select(F.col(keys.columns[0]).alias(key))
    return df.where(~picked).unionByName(df.where(picked).join(own, key, "left_anti").select(*df.columns))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold up to ``limit`` bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total, start = 0, 0
    for row, size in enumerate(sizes):
        if row > start and total + size > limit:
            yield batch.slice(start, row - start)
            total, start = 0, row
        total += int(size)
    if start < len(sizes):
        yield batch.slice(start)


def release_memory() -> None:
    """Give what a large piece of work has freed back to the machine; the worker that did it goes on with other tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def texts(batch: pa.RecordBatch, column: str) -> pa.Array:
    """The text column without NULLs; a missing text is empty."""
    return pc.fill_null(batch.column(column), "")


def coded_words(lists: pa.ListArray, keep_empty: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(offsets of the rows, code of every word, distinct words) of a list of words per row.

    Empty words, which stand where white space begins or ends a text, are left out unless ``keep_empty``.
    """
    flat = lists.flatten().dictionary_encode()
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    codes = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    empty = pc.binary_length(flat.dictionary).to_numpy(zero_copy_only=False) == 0
    if empty.any() and not keep_empty:
        real = ~empty[codes]
        counts = np.bincount(np.repeat(np.arange(len(counts)), counts)[real], minlength=len(counts))
        codes = codes[real]
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64), codes, flat.dictionary


def string_bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all strings, offsets into them) without copying the strings."""
    if strings.offset or strings.null_count:
        strings = pa.concat_arrays([pc.fill_null(strings, "")])
    if len(strings) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(strings.type) or pa.types.is_large_binary(strings.type)
    _, places, data = strings.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[strings.offset : strings.offset + len(strings) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finaliser of splitmix64)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def hash_strings(strings: pa.Array) -> np.ndarray:
    """A 64-bit hash of every string: the polynomial of its bytes, scrambled together with its length."""
    raw, offsets = string_bytes(strings)
    lengths = np.diff(offsets)
    if not len(lengths):
        return np.zeros(0, np.uint64)
    width = int(lengths.max(initial=0))
    weights = powers(FNV_PRIME, width + 1)
    inside = np.arange(len(raw)) - np.repeat(offsets[:-1], lengths)
    terms = mix(raw.astype(np.uint64) + np.uint64(1)) * weights[inside]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    return mix((sums[offsets[1:]] - sums[offsets[:-1]]) ^ mix(lengths.astype(np.uint64) + np.uint64(77)))


def gather(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places starts[i] .. starts[i] + counts[i] - 1 of all i, in order."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)
