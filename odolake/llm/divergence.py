"""How far the sources of a language differ in their words.

Identical texts of a language are collapsed first: one row per text, with the number of its copies in each source. Each
text is tokenized once, and its words add to the counts of all its sources, times the copies. Sources are compared by
smoothed word shares p = 1 + floor(SCALE * (count + 1) / (N + V)) with the excess f(p, q) = floor((p - q)^2 / q). Pairs
of sources are evaluated sparsely: words that neither has add the same f(p0, q0) each, so a sum starts at V times this
value and is set right by the words of either source, and those of both. All arithmetic is in whole numbers.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from odolake.llm.common import stored
from odolake.operators.joining import join_salted

MIN_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
HELD_TERMS = 500_000  # (source, term) pairs that a task adds up before it hands them on

# Bytes of words: ASCII letters, lower-cased, and all bytes of other characters.
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def collapse(docs: DataFrame) -> DataFrame:
    """(lang, text, copies): one row per text of a language; ``copies`` lists its sources with their counts.

    Copies are counted in narrow rows. Of the texts, one per task and group reaches the shuffle.
    """
    keyed = docs.select(
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")],
        F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("h"),
    )
    counts = keyed.groupBy("lang", "h", "source").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.groupBy("lang", "h").agg(F.collect_list(F.struct("source", "n")).alias("copies"))
    texts = keyed.groupBy("lang", "h").agg(F.first("text").alias("text"))
    return texts.join(counts, ["lang", "h"]).select("lang", "text", "copies")


def _terms_of(lang: str, docs: Counter, by_source: dict[str, Counter]) -> pa.RecordBatch:
    """One row per term: its documents, and the sources that have it with their counts."""
    row_of = {term: i for i, term in enumerate(docs)}
    rows = [np.fromiter(map(row_of.__getitem__, c), np.int64, len(c)) for c in by_source.values()]
    counts = [np.fromiter(c.values(), np.int64, len(c)) for c in by_source.values()]
    which = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    row = np.concatenate(rows)
    order = np.argsort(row, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(docs)))])
    entry = pa.StructArray.from_arrays(
        [pa.array(list(by_source), pa.string()).take(pa.array(which[order])), pa.array(np.concatenate(counts)[order])], ["source", "count"]
    )
    return pa.RecordBatch.from_pydict(
        {
            "lang": pa.array([lang] * len(docs), pa.string()),
            "term": pa.array(list(docs), pa.binary()).cast(pa.string()),
            "docs": pa.array(list(docs.values()), pa.int64()),
            "counts": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entry),
        }
    )


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, docs, counts) of collapsed texts; a term can come more than once."""
    docs: dict[str, Counter] = defaultdict(Counter)
    counts: dict[str, dict[str, Counter]] = defaultdict(lambda: defaultdict(Counter))
    held = 0
    for batch in batches:
        for lang, text, copies in zip(*[batch.column(c).to_pylist() for c in ("lang", "text", "copies")]):
            words = text.translate(_TO_WORDS).split()
            if not words:
                continue
            total, tally = sum(copy["n"] for copy in copies), None
            if total == 1:
                docs[lang].update(set(words))
            else:
                tally = Counter(words)
                docs[lang].update(dict.fromkeys(tally, total))
            for copy in copies:
                own = counts[lang][copy["source"]]
                held -= len(own)
                own.update(words if tally is None else {word: n * copy["n"] for word, n in tally.items()})
                held += len(own)
            if held > HELD_TERMS:
                yield from [_terms_of(lang, docs[lang], by_source) for lang, by_source in counts.items()]
                docs.clear()
                counts.clear()
                held = 0
    yield from [_terms_of(lang, docs[lang], by_source) for lang, by_source in counts.items()]


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, total, counts) of the terms in at least ``min_docs`` documents of a language.

    ``counts`` lists the sources that have the term, so it is bounded by the sources of a language. Tasks add terms up
    before the one shuffle, so a very common term is a row per task and fill of the task's counters.
    """
    texts = collapse(docs).withColumn("text", F.col("text").cast("binary"))
    found = texts.mapInArrow(_count_terms, "lang string, term string, docs long, counts array<struct<source string, count long>>")
    found = found.repartition("lang", "term").select("lang", "term", "docs", F.posexplode("counts").alias("at", "own"))
    found = found.groupBy("lang", "term", F.col("own.source").alias("source")).agg(
        F.sum(F.when(F.col("at") == 0, F.col("docs")).otherwise(F.lit(0))).alias("docs"), F.sum("own.count").alias("count")
    )
    terms = found.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"),
        F.sum("count").alias("total"),
        F.collect_list(F.struct("source", "count")).alias("counts"),
    )
    return terms.where(F.col("docs") >= min_docs).drop("docs")


def share(count: str, size: str, terms: str) -> Column:
    """p of a term from the names of its count, the sum of counts and the number of terms; exact for any counts."""
    whole = f"({count} + 1) * {SCALE} div ({size} + {terms})"
    wide = f"CAST({count} + 1 AS DECIMAL(24, 0)) * {SCALE} div CAST({size} + {terms} AS DECIMAL(24, 0))"
    return F.expr(f"1 + CASE WHEN {count} < {2**63 // SCALE - 1} THEN {whole} ELSE {wide} END")


def excess(p: str, q: str) -> str:
    """SQL of f(p, q) = floor((p - q)^2 / q); p and q are at most SCALE + 1, so the square fits a bigint."""
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


def _groups(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, source, size, vocab, p0) of every group of documents; p0 is the share of a term that it lacks."""
    sizes = terms.select("lang", F.inline("counts")).groupBy("lang", "source").agg(F.sum("count").alias("size"))
    vocab = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("vocab"))
    groups = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    groups = groups.join(sizes, ["lang", "source"], "left").join(vocab, "lang", "left")
    groups = groups.fillna(0, ["size", "vocab"])
    return groups.withColumn("p0", F.when(F.col("vocab") > 0, share("0", "size", "vocab")))


def _pair_values(groups: DataFrame, own: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of sources of a language."""
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    base = groups.join(other, "lang").where("source <> item")
    base = base.select("lang", "source", "item", F.expr(f"coalesce(vocab * {excess('p0', 'q0')}, 0)").alias("value"))

    # Terms of one of the two, as if the other lacked them; alike shares of a source at once.
    alike = own.groupBy("lang", "source", "p", "p0").agg(F.count(F.lit(1)).alias("n"))
    one = alike.join(other, "lang").where("source <> item")
    ahead = F.struct("source", "item", F.expr(f"n * ({excess('p', 'q0')} - {excess('p0', 'q0')})").alias("value"))
    back = F.struct(
        F.col("item").alias("source"), F.col("source").alias("item"), F.expr(f"n * ({excess('q0', 'p')} - {excess('q0', 'p0')})").alias("value")
    )
    one = one.select("lang", F.inline(F.array(ahead, back)))

    # Terms of both: what the two evaluations above get wrong.
    shared = own.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("source", "p", "p0"))).alias("all"))
    pairs = shared.where(F.size("all") > 1).select("lang", "all", F.posexplode("all").alias("i", "a"))
    pairs = pairs.select("lang", "a", F.explode(F.slice("all", F.col("i") + 2, F.size("all"))).alias("b"))
    right = lambda p, p0, q, q0: f"{excess(p, q)} - {excess(p, q0)} - {excess(p0, q)} + {excess(p0, q0)}"
    both = pairs.groupBy("lang", F.col("a.source").alias("a"), F.col("b.source").alias("b")).agg(
        F.sum(F.expr(right("a.p", "a.p0", "b.p", "b.p0"))).alias("ab"), F.sum(F.expr(right("b.p", "b.p0", "a.p", "a.p0"))).alias("ba")
    )
    both = both.selectExpr(
        "lang",
        "inline(array(named_struct('source', a, 'item', b, 'value', ab), named_struct('source', b, 'item', a, 'value', ba)))",
    )
    return base.union(one).union(both).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) over ``docs`` (text, lang, source).

    ``pair``: the other sources of the language, by the summed excess of the source's shares over theirs, all ranks.
    ``term``: the terms that the source uses more than its language does, by excess, ranks to ``top``. Ranks go by value
    from the highest, then by item. Null text, lang and source count as empty ones. Rows that repeat count each.
    Languages without a kept term have pairs of value 0 and no terms. Very long texts are tokenized whole. Other
    columns are ignored whatever their names. An empty table gives an empty table.
    """
    terms = stored(kept_terms(docs, min_docs), "terms")
    groups = stored(_groups(docs, terms), "groups")
    whole = terms.groupBy("lang").agg(F.sum("total").alias("all_size"))
    # A hot source has most of the rows of its language, so rows are dealt by a salt too.
    own = join_salted(terms.select("lang", "term", "total", F.inline("counts")), groups, ["lang", "source"])
    own = own.withColumn("p", share("count", "size", "vocab"))

    lead = join_salted(own, whole, "lang").withColumn("q", share("total", "all_size", "vocab")).where("p > q")
    lead = lead.select("lang", "source", F.col("term").alias("item"), F.expr(excess("p", "q")).alias("value"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    lead = lead.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    pairs = _pair_values(groups, own).withColumn("rank", F.row_number().over(ranked))
    out = [
        df.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), "rank")
        for df, part in ((pairs, "pair"), (lead, "term"))
    ]
    return out[0].union(out[1])
