"""Corpus pipeline: toxicity, line dedup, near-duplicates, benchmark decontamination, mixing to target weights.

Every stage takes (spark, docs, sf_dir) and returns documents that the next one takes; ``run`` writes each result as
Parquet to the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from odolake.llm.common import crc_mod, stored, table
from odolake.llm.decontaminate import decontaminate
from odolake.llm.line_dedup import dedup_lines
from odolake.llm.mixing import mix
from odolake.llm.near_dedup import near_duplicates
from odolake.llm.toxicity import fit, labelled_texts

REJECT_AT = 0.5
NEAR_PERCENT = 80  # least Jaccard similarity of near-duplicates; the 85 of op9 is that query's own


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``REJECT_AT``. Learns from four fifths of the labelled documents.

    Rows without text stay, as they score like any text without a word. Without labels of both kinds all stay.
    """
    labels = table(spark, sf_dir, "labels").where(crc_mod(F.col("doc_id"), 5) != 0)
    model = fit(labelled_texts(docs, labels))
    if model.trees is None:
        return docs
    return model.score(docs).where(F.col("score") < REJECT_AT).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one has; those of which nothing is left go.

    Documents that were blank before stay as they are, also null ones. ``n_chars`` follows the text. Repeated rows keep the
    same lines, documents without id come last. Columns of any name come through.
    """
    columns = docs.columns
    plain = docs.select("doc_id", "text", F.struct(*[c for c in columns if c != "text"]).alias("row"))
    done = dedup_lines(plain)
    emptied = (F.col("line_dedup.n_exact") + F.col("line_dedup.n_near") > 0) & (F.trim("text") == "")
    rest = done.where(~F.coalesce(emptied, F.lit(False)))
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return rest.select(*[(changed[c] if c in changed else F.col("row")[c]).alias(c) for c in columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates; of repeated rows one stays."""
    kept = near_duplicates(docs, NEAR_PERCENT).where("kept").select(F.col("doc_id").alias("k_id"), F.col("text_hash").alias("k_hash"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("h"), F.col("doc_id").alias("d"))
    rows = rows.join(kept, F.col("d").eqNullSafe(F.col("k_id")) & (F.col("h") == F.col("k_hash")), "left_semi")
    return rows.dropDuplicates(["d", "h"]).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item. Without items, or without a word, a document stays."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).where("n_hit = 0").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes words of, with size, source_size, target and taken (words, repeats counted).

    Rows with the same id and text are one document, of which ``taken`` is the sum. Own columns of these four names are
    replaced. A document without words is not taken.
    """
    dealt = mix(docs).groupBy(F.col("doc_id").alias("k_id"), F.col("text_hash").alias("k_hash"))
    dealt = dealt.agg(
        F.struct(
            F.sum("size").alias("size"),
            F.max("source_size").alias("source_size"),
            F.max("target").alias("target"),
            F.sum("taken").alias("taken"),
        ).alias("mix")
    ).where("mix.taken > 0")
    own = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken")]
    rows = docs.select(F.struct(*own).alias("row"), F.xxhash64("text").alias("h"), F.col("doc_id").alias("d"))
    rows = rows.join(dealt, F.col("d").eqNullSafe(F.col("k_id")) & (F.col("h") == F.col("k_hash")))
    return rows.dropDuplicates(["d", "h"]).select("row.*", "mix.*")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: Boosted trees have no SQL form; the stages are tested one by one against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
