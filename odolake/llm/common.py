"""Shared helpers: tables, stored intermediate results, words and shingles of Arrow text columns.

Text kernels work on the UTF-8 bytes of many texts at once. A word is hashed to 64 bits, so equality of words,
shingles and windows below means equality of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from odolake.session import shared_dir

CHUNK_BYTES = 2_000_000  # text handled at once by one task
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and survives lost executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _PRIME
    return x ^ (x >> np.uint64(32))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _PRIME)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _PRIME, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def byte_class(outside: list[tuple[int, int]]) -> np.ndarray:
    """Which bytes belong to words, from the inclusive ranges that do not."""
    inside = np.ones(256, bool)
    for low, high in outside:
        inside[low : high + 1] = False
    return inside


NOT_SPACE = byte_class([(0x20, 0x20), (0x09, 0x0D)])
ALNUM = byte_class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])  # after lower-casing A-Z


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts (null: empty) and the offsets of the texts in them."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES, text: str = "text"):
    """Cut batches into runs of rows of about ``limit`` bytes of text; a longer text is a run of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            done = ends[at] - sizes[at]
            to = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def words(texts: pa.Array, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and the bounds of each text in them (length texts + 1).

    ``inside`` tells the bytes of words after lower-casing A-Z.
    """
    flat, offsets = text_bytes(texts)
    low = _LOWER[flat]
    within = inside[low]
    before, after = np.zeros_like(within), np.zeros_like(within)
    before[1:], after[:-1] = within[:-1], within[1:]
    filled = np.flatnonzero(np.diff(offsets) > 0)
    before[offsets[filled]] = False
    after[offsets[filled + 1] - 1] = False
    starts = np.flatnonzero(within & ~before)
    lengths = np.flatnonzero(within & ~after) + 1 - starts
    bounds = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    at = np.flatnonzero(within)
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(at)) - np.repeat(first, lengths)
    hashed = np.add.reduceat(_BYTE[low[at]] * powers(int(lengths.max()))[place], first)
    return mix(hashed + lengths.astype(np.uint64)), bounds


def grams(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive values (also those that cross texts; see ``whole``)."""
    if len(values) < n:
        return np.zeros(0, np.uint64)
    power, out = powers(n), np.zeros(len(values) - n + 1, np.uint64)
    for i in range(n):
        out += values[i : len(values) - n + 1 + i] * power[n - 1 - i]
    return mix(out + np.uint64(n))


def owners(bounds: np.ndarray) -> np.ndarray:
    """The text of every word."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def whole(owner: np.ndarray, n: int) -> np.ndarray:
    """Which runs of ``n`` words lie in one text."""
    return owner[: len(owner) - n + 1] == owner[n - 1 :] if len(owner) >= n else np.zeros(0, bool)


def shingle_sets(texts: pa.Array, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``n``-word shingles of every text, sorted, and the bounds of each text in them.

    A text of fewer words has its whole sequence as the one shingle; a text without words has none.
    """
    hashed, bounds = words(texts, NOT_SPACE)
    owner = owners(bounds)
    keep = whole(owner, n)
    values, at = [grams(hashed, n)[keep]], [owner[: len(keep)][keep]]
    counts = np.diff(bounds)
    for short in range(1, n):
        some = np.flatnonzero(counts == short)
        if len(some):
            values.append(grams(hashed, short)[bounds[some]])
            at.append(some)
    value, text = np.concatenate(values), np.concatenate(at)
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    return value[new], np.searchsorted(text[new], np.arange(len(counts) + 1))


def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Arrow list column of 64-bit values."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))
