"""Document fingerprints by Order MinHash.

A text's k-mers of code points are numbered by occurrence, so that repeats differ. Each of ``SAMPLES`` hash functions picks
the ``TUPLE`` k-mers with the smallest hashes, and the tuple of these in text order is hashed. Two texts agree in
a tuple only if they share its k-mers and their order, which follows edit distance rather than set overlap.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from odolake.llm.common import grams, mix

K = 10
TUPLE = 2
SAMPLES = 64
MOST_CHUNKS = 10_000
_SEEDS = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64)) | np.uint64(1)
_SALTS = mix(np.arange(1001, SAMPLES + 1001, dtype=np.uint64))
_CELLS = 1 << 22  # numbers in one hash matrix


def kmers(text: str, k: int = K) -> np.ndarray:
    """Hashes of the occurrence-numbered k-mers in text order; a shorter text is one k-mer, an empty one none."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if not len(points):
        return points
    hashed = grams(mix(points + np.uint64(1)), min(k, len(points)))
    if len(hashed) < 2:
        return hashed
    # Only k-mers that share a slot of a counting table can repeat; number these.
    bits = min(20, max(8, int(len(hashed)).bit_length() + 4))
    slot = (hashed >> np.uint64(64 - bits)).astype(np.int64)
    some = np.flatnonzero(np.bincount(slot, minlength=1 << bits)[slot] > 1)
    order = some[np.argsort(hashed[some], kind="stable")]
    value = hashed[order]
    if len(value):
        new = np.ones(len(value), bool)
        new[1:] = value[1:] != value[:-1]
        start = np.maximum.accumulate(np.where(new, np.arange(len(value)), 0))
        number = (np.arange(len(value)) - start).astype(np.uint64)
        again = number > 0
        hashed[order[again]] = mix(value[again] + number[again] * np.uint64(0x9E3779B1))
    return hashed


def fingerprint(text: str) -> np.ndarray:
    """``SAMPLES`` 16-bit hashes of ordered tuples."""
    hashed = kmers(text)
    n = len(hashed)
    if n <= 1:
        return (mix(_SALTS + (hashed[0] if n else np.uint64(0))) >> np.uint64(48)).astype(np.uint16)
    out = np.empty(SAMPLES, np.uint64)
    step = max(1, _CELLS // n)
    for start in range(0, SAMPLES, step):
        ranked = (hashed[None, :] ^ _SALTS[start : start + step, None]) * _SEEDS[start : start + step, None]
        rows = np.arange(len(ranked))
        picked = []
        for _ in range(min(TUPLE, n)):
            at = ranked.argmin(axis=1)
            picked.append(at)
            ranked[rows, at] = np.uint64(0xFFFFFFFFFFFFFFFF)
        ordered = np.sort(np.stack(picked, axis=1), axis=1)
        value = np.zeros(len(ranked), np.uint64)
        for at in ordered.T:
            value = mix(value * np.uint64(31) + hashed[at])
        out[start : start + step] = value
    return (out >> np.uint64(48)).astype(np.uint16)


def as_text(print_: np.ndarray) -> str:
    return print_.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


_RESULT = [
    T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()),
    T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()),
    T.StructField("near_edited", T.DoubleType()),
    T.StructField("near_next", T.DoubleType()),
]


def _scan(batches):
    """Rows (chunk, doc_id, tail, text) sorted by chunk and order; every row but the tail is compared with the next."""
    held = None
    for batch in batches:
        for chunk, doc_id, tail, text in zip(*[batch.column(c).to_pylist() for c in ("chunk", "doc_id", "tail", "text")]):
            text = text or ""
            now = (chunk, doc_id, tail, text, fingerprint(text))
            if held is not None and held[0] == chunk and not held[2]:
                yield _compare(held, now)
            held = now


def _compare(one, following) -> dict:
    _, doc_id, _, text, own = one
    half = len(text) // 2
    edited = text[: len(text) - half] + following[3][:half]
    theirs = fingerprint(edited)
    return {
        "doc_id": doc_id,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        "fingerprint": as_text(own),
        "edited_fingerprint": as_text(theirs),
        "near_edited": likeness(own, theirs),
        "near_next": likeness(own, following[4]),
    }


def _batched(schema: pa.Schema, rows: int = 2000):
    """The scan with its one-row results put together."""

    def scan(batches):
        held = []
        for one in _scan(batches):
            held.append(one)
            if len(held) == rows:
                yield pa.RecordBatch.from_pylist(held, schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    return scan


def with_edited(docs: DataFrame, rows_per_chunk: int = 2000) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its fingerprint, that of its edited text, and their likeness.

    The edited text replaces the last half of the code points by the start of the next document in descending
    doc_id order; after the last comes the first. A single row is its own next. Null texts count as empty. Rows with the same id lie in order of
    a hash of their text, equal rows in either order; rows without id come last. Equal texts have equal
    fingerprints; two texts without any code point have likeness 1.

    The order is cut into chunks at quantiles of the id. Each text is shuffled once, and the first row of every
    chunk also goes to the chunk before, so no task sees more than its chunks. There are at most ``MOST_CHUNKS``
    chunks, so their first rows may be broadcast. Rows with one and the same id are in one chunk.
    """
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    z, down = F.col("doc_id").isNull(), -F.col("doc_id").cast("decimal(38,0)")
    n = docs.count()
    pieces = min(MOST_CHUNKS, max(1, -(-n // rows_per_chunk)))
    steps = [i / pieces for i in range(1, pieces)]
    splits = docs.agg(F.percentile_approx("doc_id", steps, 10 * MOST_CHUNKS)).first()[0] if steps else None
    cuts = np.unique(np.array(splits or [], np.int64))

    @F.pandas_udf("int")
    def chunk_of(ids: pd.Series) -> pd.Series:
        at = len(cuts) - np.searchsorted(cuts, ids.fillna(0).to_numpy(np.int64), "left")
        return pd.Series(np.where(ids.isna(), len(cuts), at))

    placed = keyed.withColumn("chunk", chunk_of("doc_id"))
    order = F.struct(z.alias("z"), down.alias("down"), "h")
    firsts = placed.groupBy("chunk").agg(F.min(order).alias("f")).orderBy("f").collect()  # one per chunk
    if not firsts:
        cycle = []
    else:
        cycle = [(r.f.z, r.f.down, r.f.h, firsts[i - 1].chunk) for i, r in enumerate(firsts)]
    tails = docs.sparkSession.createDataFrame(cycle, "t_z boolean, t_down decimal(38,0), t_h long, t_chunk int")
    same = (z == F.col("t_z")) & down.eqNullSafe(F.col("t_down")) & (F.col("h") == F.col("t_h"))
    columns = ["chunk", "doc_id", "tail", "text", "h"]
    tail_rows = keyed.join(F.broadcast(tails), same).withColumns({"chunk": F.col("t_chunk"), "tail": F.lit(True)})
    every = placed.withColumn("tail", F.lit(False)).select(columns).union(tail_rows.select(columns))
    ordered = every.repartition("chunk").sortWithinPartitions("chunk", "tail", z, F.col("doc_id").desc(), "h")
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType), *_RESULT]
    )
    return ordered.select("chunk", "doc_id", "tail", "text").mapInArrow(_batched(to_arrow_schema(schema)), schema)
