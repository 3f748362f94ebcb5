"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

A lexicon is learned first: words and word beginnings (4, 5 and 6 bytes) that labelled toxic texts use and others do
not, by the likelihood ratio of their document counts. The bound on the ratio rises with the number of candidates in
as many documents, so that chance alone adds next to none. Features are the densities of these lexicons, second-person words and how close they
stand to lexicon words, capitals, punctuation and obfuscated spellings. Lexicon and trees learn from four fifths of the
labelled rows; the others calibrate the trees' margins.

Words are counted over all labelled rows. Trees and curve are fitted on a sample of at most about ``fit_rows`` of them,
chosen by a hash of the id. Scoring reads every text whole, in one pass without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from odolake.llm import common
from odolake.llm.common import chunks, owners, stored, text_bytes
from odolake.operators.joining import join_salted

FIT_ROWS = 40_000
CHANCE = 0.1
MIN_SHARE = 1e-4  # of the toxic texts, that an entry stands in more of
HELD = 1_000_000  # counts that a task adds up before it hands them on
WORD = common.byte_class([(0x00, 0x29), (0x2B, 0x2F), (0x3A, 0x3F), (0x5B, 0x60), (0x7B, 0x7F)])  # letters, digits, @, *
LETTERS = common.byte_class([(0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])
KINDS = (0, 4, 5, 6)  # whole words, then beginnings of so many bytes
NEAR = 5  # words between a second-person word and a lexicon word
# Second-person words of the languages at hand, and letters commonly swapped for digits and signs.
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos usted ustedes tú ti".split()
SWAPPED = dict(zip("0134578@", "oieastba"))
FEATURES = [
    *[f"lexicon_{kind}" for kind in KINDS],
    *[f"hits_{kind}" for kind in KINDS],
    "plain_hits",
    "second_person",
    "second_person_near",
    "capitals",
    "capital_words",
    "exclamations",
    "punctuation",
    "stars",
    "swapped",
    "repeated",
    "log_words",
]


def _hashes(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Per kind the hash of every word or its beginning (0: too short), the bounds of the texts, and swapped words.

    Signs and digits that stand for letters count as these letters inside a word that has letters too.
    """
    flat, offsets = text_bytes(texts)
    low = common._LOWER[flat]
    within = WORD[flat]
    before, after = np.zeros_like(within), np.zeros_like(within)
    before[1:], after[:-1] = within[:-1], within[1:]
    filled = np.flatnonzero(np.diff(offsets) > 0)
    before[offsets[filled]] = False
    after[offsets[filled + 1] - 1] = False
    starts = np.flatnonzero(within & ~before)
    lengths = np.flatnonzero(within & ~after) + 1 - starts
    bounds = np.searchsorted(starts, offsets)
    if not len(starts):
        return [np.zeros(0, np.uint64)] * len(KINDS), bounds, np.zeros(0, bool)
    at = np.flatnonzero(within)
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(at)) - np.repeat(first, lengths)
    letter = LETTERS[flat[at]]
    lettered = np.add.reduceat(letter.astype(np.int64), first)
    plain = _UNSWAPPED[low[at]]
    odd = (plain != low[at]) & np.repeat((lettered >= 2) & (lettered < lengths), lengths)
    swapped = np.add.reduceat(odd.astype(np.int64), first) > 0
    spelled = np.where(odd, plain, low[at])
    terms = common._BYTE[spelled] * common.powers(int(lengths.max()))[place]
    out = []
    for kind in KINDS:
        if kind:
            part = np.add.reduceat(np.where(place < kind, terms, np.uint64(0)), first)
            value = np.where(lengths > kind, common.mix(part + np.uint64(kind)), np.uint64(0))
        else:
            value = common.mix(np.add.reduceat(terms, first) + (lengths.astype(np.uint64) << np.uint64(8)))
        out.append(value)
    return out, bounds, swapped


_UNSWAPPED = np.arange(256, dtype=np.uint8)
for _sign, _letter in SWAPPED.items():
    _UNSWAPPED[ord(_sign)] = ord(_letter)
_YOU = np.unique(_hashes(pa.array([" ".join(SECOND_PERSON)]))[0][0])


def _add_up(parts: list[np.ndarray]) -> np.ndarray:
    """Rows (hash, bad, every) with one row per hash."""
    rows = np.concatenate(parts, axis=1)
    rows = rows[:, np.argsort(rows[0], kind="stable")]
    first = np.flatnonzero(np.concatenate([[True], rows[0, 1:] != rows[0, :-1]])) if rows.shape[1] else np.zeros(0, np.int64)
    sums = [np.add.reduceat(rows[i], first) if len(first) else rows[i] for i in (1, 2)]
    return np.stack([rows[0, first], *sums])


def _counts(batches):
    """(kind, hash) with the numbers of toxic and other texts that have it, added up until ``HELD`` are at hand."""
    held: dict[int, list[np.ndarray]] = {kind: [] for kind in KINDS}

    def handed():
        for kind, parts in held.items():
            if parts:
                found = _add_up(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(found.shape[1], kind, np.int32)), *[pa.array(row) for row in found]],
                    ["kind", "hash", "bad", "every"],
                )
                parts.clear()

    for part in chunks(batches):
        hashes, bounds, _ = _hashes(part.column("text"))
        owner = owners(bounds)
        toxic = part.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
        for kind, value in zip(KINDS, hashes):
            # Stable, so that the texts of a hash ascend and a text that has it several times is seen once.
            order = np.argsort(value, kind="stable")
            value, text = value[order], owner[order]
            new = np.ones(len(value), bool)
            new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
            new &= value != 0
            bad = toxic[text[new]]
            held[kind].append(_add_up([np.stack([value[new].view(np.int64), bad, np.ones(len(bad), np.int64)])]))
        if sum(x.shape[1] for parts in held.values() for x in parts) > HELD:
            for kind, parts in held.items():
                held[kind] = [_add_up(parts)]
            if sum(x.shape[1] for parts in held.values() for x in parts) > HELD / 2:
                yield from handed()
    yield from handed()


def word_counts(labelled: DataFrame) -> DataFrame:
    """(kind, hash, bad, every): in how many texts of ``labelled`` (text, toxic) an entry stands, and in how many toxic ones."""
    found = labelled.select("text", "toxic").mapInArrow(_counts, "kind int, hash long, bad long, every long")
    return found.groupBy("kind", "hash").agg(F.sum("bad").alias("bad"), F.sum("every").alias("every"))


def learn_lexicon(labelled: DataFrame) -> dict[int, np.ndarray]:
    """Hashes by kind that are tied to toxic texts, from the counts of all rows (text, toxic).

    An entry stands in more than ``MIN_SHARE`` of the toxic texts. So there are at most ``1 / MIN_SHARE`` times as many as a
    toxic text has distinct entries on average, whatever the number of texts, and they fit the driver.
    """
    totals = labelled.agg(F.sum("toxic"), F.count("*")).first()
    bad, every = float(totals[0] or 0), float(totals[1] or 0)
    counts = stored(word_counts(labelled), "counts")
    alike = counts.groupBy("kind", "every").agg(F.count("*").alias("alike"))

    def term(seen, total) -> F.Column:
        return F.when(seen > 0, seen * F.log(seen / total)).otherwise(0.0)

    rate = bad / max(every, 1.0)
    ratio = 2 * (
        term(F.col("bad"), F.col("every") * rate) + term(F.col("every") - F.col("bad"), F.col("every") * (1 - rate))
    )
    # Chance reaches a ratio of x with a probability of about exp(-x / 2), so this many entries are chance at most. One
    # alone must be unlikely enough already, which leaves few to join with the number of entries in as many texts.
    chance = F.exp(-ratio / 2)
    likely = counts.where((F.col("bad") > F.col("every") * max(0.5, rate)) & (F.col("bad") > MIN_SHARE * bad) & (chance < CHANCE))
    chosen = join_salted(likely, alike, ["kind", "every"]).where(chance * F.col("alike") < CHANCE).select("kind", "hash").collect()
    return {k: np.unique(np.array([r.hash for r in chosen if r.kind == k], np.int64).view(np.uint64)) for k in KINDS}


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return among[at] == values


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(float)


def measure(texts: pa.Array, lexicon: dict[int, np.ndarray]) -> np.ndarray:
    """Feature rows, in the order of ``FEATURES``; every density is per word or per byte."""
    hashes, bounds, swapped = _hashes(texts)
    flat, offsets = text_bytes(texts)
    n_words, n_bytes = np.maximum(np.diff(bounds), 1), np.maximum(np.diff(offsets), 1)
    hits = [_member(value, lexicon[kind]) for kind, value in zip(KINDS, hashes)]
    any_hit = np.logical_or.reduce(hits)
    you = _member(hashes[0], _YOU)
    owner = owners(bounds)
    last = np.full(len(you), -(10**9))
    spots = np.flatnonzero(you)
    last[spots] = spots
    last = np.maximum.accumulate(last) if len(last) else last
    following = np.full(len(you), 10**9)
    following[spots] = spots
    following = np.minimum.accumulate(following[::-1])[::-1] if len(following) else following
    place = np.arange(len(you))
    beside = (place - last <= NEAR) & (owner[np.maximum(last, 0)] == owner) if len(you) else you
    ahead = (following - place <= NEAR) & (owner[np.minimum(following, max(len(you) - 1, 0))] == owner) if len(you) else you
    upper = (flat >= 65) & (flat <= 90)
    twice = np.zeros(len(flat), bool)
    twice[2:] = (flat[2:] == flat[1:-1]) & (flat[1:-1] == flat[:-2]) & LETTERS[flat[2:]]
    shouting = np.zeros(len(flat), bool)
    shouting[1:] = upper[1:] & upper[:-1]
    marks = ((flat >= 33) & (flat <= 47)) | ((flat >= 58) & (flat <= 64))
    per_byte = lambda flags: _per_text(flags, offsets) / n_bytes
    per_word = lambda flags: _per_text(flags, bounds) / n_words
    columns = [
        *[per_word(h) for h in hits],
        *[np.log1p(_per_text(h, bounds)) for h in hits],
        np.log1p(_per_text(any_hit & ~swapped, bounds)),
        per_word(you),
        per_word(any_hit & (beside | ahead)),
        per_byte(upper),
        per_byte(shouting),
        per_byte(flat == 33),
        per_byte(marks),
        per_byte(flat == 42),
        per_word(swapped),
        per_byte(twice),
        np.log1p(np.diff(bounds)),
    ]
    return np.stack(columns, axis=1)


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of the documents with a label; of labels that repeat an id the toxic one counts.

    Both sides grow with the corpus and are shuffled once; the hint keeps the plan alike at every size.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return docs.select("doc_id", "text").join(known.hint("merge"), "doc_id")


def with_features(docs: DataFrame, lexicon: dict[int, np.ndarray], keep: list[str]) -> DataFrame:
    """(``keep`` columns, array of features) of every row of ``docs``."""

    def scan(batches):
        for part in chunks(batches):
            rows = measure(part.column("text"), lexicon)
            values = pa.ListArray.from_arrays(
                pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel())
            )
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], values], [*keep, "measures"])

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    found = docs.select(*keep, *["text"] * ("text" not in keep)).mapInArrow(scan, f"{kinds}, measures array<double>")
    spread = found.select(*keep, *[F.col("measures")[i].alias(name) for i, name in enumerate(FEATURES)])
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(spread).select(*keep, "features")


class Model:
    """A fitted scorer; ``rate`` alone scores where the labels hold one class only or none."""

    def __init__(self, lexicon: dict[int, np.ndarray], trees, curve, rate: float):
        self.lexicon, self.trees, self.curve, self.rate = lexicon, trees, curve, rate

    def score(self, docs: DataFrame) -> DataFrame:
        """(row, score) of every row of ``docs``; ``row`` is a struct of all its columns, whatever their names.

        Only the text is scored. Null and empty texts have zero features and get a score too; repeated rows get equal scores.
        """
        rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
        if self.trees is None:
            return rows.select("row", F.lit(self.rate).alias("score"))
        scored = _margin(self.trees, with_features(rows, self.lexicon, ["row"]))
        fitted = self.curve.transform(scored)
        return fitted.select("row", F.least(F.lit(1.0), F.greatest(F.lit(0.0), "prediction")).alias("score"))


def _margin(trees, df: DataFrame) -> DataFrame:
    raw = trees.transform(df)
    return raw.withColumn("margin", vector_to_array("rawPrediction")[1]).drop("rawPrediction", "probability", "prediction")


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS, rounds: int = 12, depth: int = 4, seed: int = 7) -> Model:
    """Fit on rows (doc_id, text, toxic); rows without label are left out.

    The rows are written once and read three times. Words are counted over all of them; ``fit_rows`` bounds the sample that
    trees and curve are fitted on. Without rows of both classes the share of toxic rows is every text's score.
    """
    known = labelled.where(F.col("toxic").isNotNull()).select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))
    hashed = lambda salt: F.xxhash64(F.lit(seed + salt), "doc_id")
    known = known.select("*", F.pmod(hashed(1), F.lit(5)).alias("part"), (F.pmod(hashed(0), F.lit(1_000_000)) / 1e6).alias("spot"))
    known = stored(known, "labelled")
    counts = known.agg(F.count("*").alias("n"), F.sum("toxic").alias("bad")).first()
    n, bad = counts.n, counts.bad or 0
    if bad in (0, n):
        return Model({}, None, None, bad / n if n else 0.0)
    # The fifth for the curve is unseen by the lexicon and the trees, unless either side lacks a class.
    kinds = known.groupBy((F.col("part") == 0).alias("apart")).agg(F.countDistinct("toxic").alias("classes")).collect()
    apart = len(kinds) == 2 and all(r.classes == 2 for r in kinds)
    lexicon = learn_lexicon(known.where("part > 0") if apart else known)
    sample = known.where(F.col("spot") < min(1.0, fit_rows / n))
    rows = stored(with_features(sample, lexicon, ["doc_id", "toxic", "part"]), "features")
    rows = rows.withColumn("label", F.col("toxic").cast("double"))
    train, rest = (rows.where("part > 0"), rows.where("part = 0")) if apart else (rows, rows)
    if train.select("label").distinct().count() < 2 or rest.isEmpty():
        train = rest = rows
    trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=seed, maxBins=32).fit(train)
    curve = IsotonicRegression(featuresCol="margin", labelCol="label").fit(_margin(trees, rest))
    return Model(lexicon, trees, curve, bad / n)
