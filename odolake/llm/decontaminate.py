"""Benchmark decontamination by winnowing.

Texts are lower-cased (A-Z) and cut into words of letters, digits and non-ASCII characters. Of every ``SPAN``
consecutive 5-word grams the one with the smallest hash is a fingerprint, so any shared run of ``WINDOW`` words has a
shared fingerprint. Fingerprints of documents are looked up among those of the benchmark; hits are extended to the
exact runs of ``WINDOW`` words. An item of fewer words is one window of its own length; all grams of that length are
its fingerprints.

1. Fingerprints of documents are joined with those of the items; a document without a shared one holds no window.
2. In the others every run of words as long as a window gets its hash, and these are joined with the items' windows. A
   window that several items have is one row with their ids, so a common passage makes no product of items and documents.
3. The words of the joined runs are counted once each, and the ids of their items are put together.

Bitmaps of fixed size (see ``marks``) keep fingerprints, texts and runs without a partner out of the shuffles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from odolake.llm.common import ALNUM, chunks, grams, lists, owners, stored, whole, words
from odolake.llm.marks import marked, marks, with_mark
from odolake.operators.joining import join_salted

WINDOW, GRAM = 10, 5
SPAN = WINDOW - GRAM + 1


def winnow(hashed: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the runs of ``WINDOW`` words and the texts they are from (repeats possible)."""
    keep = whole(owner, WINDOW)
    values = grams(hashed, GRAM)
    if not keep.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    least = values[: len(keep)].copy()
    for i in range(1, SPAN):
        np.minimum(least, values[i : len(keep) + i], out=least)
    least, text = least[keep], owner[: len(keep)][keep]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    return least[new], text[new]


def _item_words(batches):
    for part in chunks(batches):
        yield pa.RecordBatch.from_arrays(
            [part.column("item_id"), lists(*words(part.column("text"), ALNUM))], ["item_id", "words"]
        )


def _item_prints(batches):
    """(finger) of the items: winnowed grams, or the one gram of an item shorter than ``WINDOW``."""
    for batch in batches:
        for row in batch.column("words").to_pylist():
            hashed = np.array(row, np.int64).view(np.uint64)
            long = len(hashed) >= WINDOW
            found = winnow(hashed, np.zeros(len(hashed), np.int64))[0] if long else grams(hashed, max(len(hashed), 1))
            yield pa.RecordBatch.from_pydict({"finger": pa.array(np.unique(found).view(np.int64))})


def _item_windows(batches):
    """(id, n, hash) of the windows of the items."""
    for batch in batches:
        for name, row in zip(batch.column("id").to_pylist(), batch.column("words").to_pylist()):
            n = min(WINDOW, len(row))
            found = np.unique(grams(np.array(row, np.int64).view(np.uint64), n)) if n else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_pydict(
                {
                    "id": pa.array([name] * len(found), pa.string()),
                    "n": pa.array([n] * len(found), pa.int32()),
                    "hash": pa.array(found.view(np.int64)),
                }
            )


def _prints(lengths: list[int]):
    """Distinct (name, finger) of every text, for items of ``WINDOW`` words and for the shorter lengths."""

    def scan(batches):
        for part in chunks(batches):
            hashed, bounds = words(part.column("text"), ALNUM)
            owner = owners(bounds)
            value, text = winnow(hashed, owner)
            values, texts = [value], [text]
            for n in lengths:
                keep = whole(owner, n)
                values.append(grams(hashed, n)[keep])
                texts.append(owner[: len(keep)][keep])
            value, text = np.concatenate(values), np.concatenate(texts)
            yield pa.RecordBatch.from_arrays(
                [part.column("name").take(pa.array(text.astype(np.int64))), pa.array(value.view(np.int64))],
                ["name", "finger"],
            )

    return scan


def _runs(lengths: list[int]):
    """(name, first, n, hash) of every run of words that is as long as a window."""

    def scan(batches):
        for part in chunks(batches):
            hashed, bounds = words(part.column("text"), ALNUM)
            owner = owners(bounds)
            for n in lengths:
                start = np.flatnonzero(whole(owner, n))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("name").take(pa.array(owner[start].astype(np.int64))),
                        pa.array(start - bounds[owner[start]]),
                        pa.array(np.full(len(start), n, np.int32)),
                        pa.array(grams(hashed, n)[start].view(np.int64)),
                    ],
                    ["name", "first", "n", "hash"],
                )

    return scan


def _count_words(batches):
    for part in chunks(batches):
        _, bounds = words(part.column("text"), ALNUM)
        yield pa.RecordBatch.from_arrays(
            [part.column("row"), part.column("name"), pa.array(np.diff(bounds).astype(np.int64))], ["row", "name", "n_words"]
        )


def _hits(texts: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(name, n_hit, items) of the texts (name, text) that hold a window."""
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    items = benchmark.select("item_id", "text").mapInArrow(_item_words, f"item_id {item_type}, words array<long>")
    items = stored(items.select(F.col("item_id").cast("string").alias("id"), "words").where(F.size("words") > 0), "items")
    windows = items.mapInArrow(_item_windows, "id string, n int, hash long")
    windows = stored(windows.groupBy("n", "hash").agg(F.collect_set("id").alias("ids")), "windows")
    prints = stored(items.mapInArrow(_item_prints, "finger long").distinct(), "prints")
    lengths = sorted(r.n for r in windows.select("n").distinct().collect())  # WINDOW at most

    short = [n for n in lengths if n < WINDOW]
    found = texts.mapInArrow(_prints(short), "name long, finger long")
    found = marked(found, F.col("finger"), marks(prints.select(F.col("finger").alias("h"))))
    near = stored(found.join(prints, "finger", "left_semi").select("name").distinct(), "near")

    near_texts = marked(texts, F.col("name"), marks(near.select(F.col("name").alias("h"))))
    near_texts = near_texts.join(near, "name", "left_semi").dropDuplicates(["name"])
    runs = near_texts.mapInArrow(_runs(lengths), "name long, first long, n int, hash long")
    runs = marked(runs, F.col("hash"), marks(windows.select(F.col("hash").alias("h"))))
    hits = stored(join_salted(runs, windows, ["n", "hash"]).select("name", "first", "n", "ids"), "hits")
    covered = hits.select("name", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("word")).distinct()
    n_hit = covered.groupBy("name").agg(F.count(F.lit(1)).alias("n_hit"))
    ids = hits.select("name", F.explode("ids").alias("id")).distinct()
    ids = ids.groupBy("name").agg(F.sort_array(F.collect_list("id")).alias("items"))
    return n_hit.join(ids, "name", "left")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): row, n_words, n_hit, items.

    ``row`` is a struct of all columns of ``docs``, whatever their names. ``items`` are the ids (as text, sorted, distinct)
    of the benchmark items with a window in the document, ``n_hit`` the words inside any window. Null and empty texts
    have no words; so have such items, which match nothing. A window of an item without id hits words but adds no id.
    Equal texts are looked up once and get equal results. Other columns of the benchmark are ignored. An empty benchmark
    hits nothing. Very long texts are cut nowhere.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text", F.xxhash64("text").alias("name"))
    hits = stored(_hits(rows.select("name", "text"), benchmark), "found")
    counted = rows.mapInArrow(_count_words, f"row {rows.schema['row'].dataType.simpleString()}, name long, n_words long")
    counted = with_mark(counted, F.col("name"), marks(hits.select(F.col("name").alias("h"))), "_near")
    # Rows without a hit are not shuffled; very many copies of a text are dealt by a salt.
    near = join_salted(counted.where("_near"), hits, "name", "left")
    both = near.unionByName(counted.where("NOT _near"), allowMissingColumns=True)
    none = F.array().cast("array<string>")
    return both.select("row", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items"))
