"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, derived from its code point. A trigram's vector binds its letters: the
product of the first letter's vector permuted twice, the second's permuted once and the third's. A text bundles
(adds) the vectors of its trigrams, a language those of its training texts. The language whose prototype has the highest cosine
with the text wins. Texts are lower-cased; runs of anything but letters count as one space.

Prototypes come from all training texts: tasks add up trigram counts per language, and the sums are bundled in
tasks again. Only the prototypes (languages x dimensions) reach the driver.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from odolake.llm.common import chunks, mix, stored

DIMENSIONS = 1024
CHUNK = 600_000  # bytes of text bundled at once
_SPACE = 32
_IS_LETTER = np.array([chr(i).isalpha() for i in range(0x10000)])


def _letters(points: np.ndarray) -> np.ndarray:
    """Code points with everything but letters as a space."""
    letter = _IS_LETTER[np.minimum(points, 0xFFFF)]
    beyond = np.flatnonzero(points >= 0x10000)
    if len(beyond):  # looked up one by one
        known, at = np.unique(points[beyond], return_inverse=True)
        letter[beyond] = np.array([chr(p).isalpha() for p in known.tolist()])[at]
    return np.where(letter, points, _SPACE)


def _vectors(letters: np.ndarray, dimensions: int) -> np.ndarray:
    """Random vector of each letter: one bit per dimension of hashes of (letter, dimension block)."""
    blocks = np.arange(dimensions // 64, dtype=np.uint64)
    bits = mix(mix(letters.astype(np.uint64)[:, None] * np.uint64(1_000_003) + np.uint64(17)) + blocks[None, :])
    raw = ((bits[:, :, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).reshape(len(letters), -1)
    return (raw.astype(np.int8) * 2 - 1).astype(np.float32)


def bind(trigrams: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Vectors of trigrams given as three code points of 21 bits each."""
    places = [(trigrams >> np.uint64(s)) & np.uint64(0x1FFFFF) for s in (42, 21, 0)]
    known, at = np.unique(np.concatenate(places), return_inverse=True)
    base = _vectors(known, dimensions)
    base[known == _SPACE] = _vectors(np.array([_SPACE], np.uint64), dimensions)
    first, second, third = at.reshape(3, -1)
    return np.roll(base, 2, axis=1)[first] * np.roll(base, 1, axis=1)[second] * base[third]


def trigram_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, trigram, count) of the padded texts; trigrams around two spaces are left out."""
    lowered = [f"  {(t or '').lower()} " for t in texts]
    joined = "".join(lowered).encode("utf-32-le", "surrogatepass")
    points = _letters(np.frombuffer(joined, "<u4").astype(np.uint64))
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != _SPACE) | (points[:-1] != _SPACE) | (owner[1:] != owner[:-1])
    points, owner = points[keep], owner[keep]
    grams = (points[:-2] << np.uint64(42)) | (points[1:-1] << np.uint64(21)) | points[2:]
    inside = (owner[:-2] == owner[2:]) & ~((points[:-2] == _SPACE) & (points[2:] == _SPACE) & (points[1:-1] == _SPACE))
    order = np.lexsort((grams[inside], owner[:-2][inside]))
    gram, text = grams[inside][order], owner[:-2][inside][order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (text[1:] != text[:-1])
    starts = np.flatnonzero(new)
    return text[starts], gram[starts], np.diff(np.append(starts, len(gram)))


def _count(batches):
    """Trigram counts of each chunk by language."""
    for part in chunks(batches):
        text, gram, count = trigram_counts(part.column("text").to_pylist())
        langs = np.array(part.column("lang").to_pylist(), object)
        names, code = np.unique(langs.astype(str), return_inverse=True)
        pair, at = np.unique(np.stack([code[text].astype(np.uint64), gram]), axis=1, return_inverse=True)
        total = np.bincount(at.ravel(), weights=count, minlength=pair.shape[1]).astype(np.int64)
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array(names[pair[0].astype(int)].tolist(), pa.string()),
                "gram": pa.array(pair[1].view(np.int64)),
                "n": pa.array(total),
            }
        )


def _bundle(dimensions: int):
    def scan(batches):
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object).astype(str)
            grams = batch.column("gram").to_numpy().view(np.uint64)
            counts = batch.column("n").to_numpy().astype(np.float64)
            for lang in np.unique(langs):
                here = langs == lang
                total = np.zeros(dimensions)
                for at in np.array_split(np.flatnonzero(here), here.sum() // 4096 + 1):
                    total += counts[at] @ bind(grams[at], dimensions)
                yield pa.RecordBatch.from_pydict({"lang": [str(lang)], "vector": pa.array([total], pa.list_(pa.float64()))})

    return scan


def prototypes(train: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Unit prototype of each language from rows (text, lang); rows without text or lang are left out."""
    known = train.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", F.col("lang").cast("string"))
    counts = known.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    parts = counts.mapInArrow(_bundle(dimensions), "lang string, vector array<double>")
    sums = parts.select("lang", F.posexplode("vector").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    vectors = stored(sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")), "prototypes")
    rows = vectors.select("lang", F.transform("v", lambda s: s["x"]).alias("v")).collect()
    out = {r.lang: np.array(r.v) for r in rows}
    return {k: v / n for k, v in sorted(out.items()) if (n := np.linalg.norm(v)) > 0}


def predict(docs: DataFrame, languages: dict[str, np.ndarray], dimensions: int = DIMENSIONS) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs`` (doc_id, text).

    ``score`` is the cosine with the winner's prototype, at least 0. A text that is null, empty or without a letter is
    ``und`` with score 0, as is every text if nothing was learned. Ties go to the language first in order.
    """
    names = np.array([*languages, "und"], object)
    profile = np.stack([*languages.values()]).astype(np.float32) if languages else np.zeros((1, dimensions), np.float32)

    def scan(batches):
        for part in chunks(batches, CHUNK):
            text, gram, count = trigram_counts(part.column("text").to_pylist())
            best, score = np.full(part.num_rows, len(names) - 1), np.zeros(part.num_rows)
            if languages and len(gram):
                known, at = np.unique(gram, return_inverse=True)
                rows, row = np.unique(text, return_inverse=True)
                bundled = np.zeros((len(rows), dimensions), np.float32)
                for start in range(0, len(known), 4096):
                    some = (at >= start) & (at < start + 4096)
                    matrix = np.zeros((len(rows), min(4096, len(known) - start)), np.float32)
                    matrix[row[some], at[some] - start] = count[some]
                    bundled += matrix @ bind(known[start : start + 4096], dimensions)
                cosine = bundled @ profile.T / np.maximum(np.linalg.norm(bundled, axis=1), 1e-9)[:, None]
                best[rows] = cosine.argmax(axis=1)
                score[rows] = np.clip(cosine.max(axis=1), 0, 1)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(names[best].tolist(), pa.string()), pa.array(score.astype(float))],
                ["doc_id", "lang_pred", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, lang_pred string, score double")
