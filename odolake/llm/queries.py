"""Registered queries of the operators, over whole tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from odolake.llm.common import crc_mod, table
from odolake.llm.twins import ORACLES  # noqa: F401


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odolake.llm.pii import replace_pii

    return replace_pii(table(spark, sf_dir, "documents")).select("doc_id", "pii.*", "text")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odolake.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odolake.llm.decontaminate import decontaminate

    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odolake.llm.licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def op5_dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odolake.llm.line_dedup import dedup_lines

    found = dedup_lines(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "line_dedup.*",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odolake.llm.toxicity import fit, labelled_texts

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    scored = fit(labelled_texts(docs, labels.where(~held_out))).score(docs).select("row.doc_id", "score")
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odolake.llm.language import predict, prototypes

    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    found = predict(docs, prototypes(docs.where(~held_out).select("text", "lang")))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odolake.llm.order_minhash import with_edited

    return with_edited(table(spark, sf_dir, "documents"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odolake.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odolake.llm.repeats import repeated_bytes

    found = repeated_bytes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op11_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odolake.llm.sharding import shard_rows

    dealt = shard_rows(table(spark, sf_dir, "documents"), columns=["doc_id"])
    return dealt.select(
        "row.doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odolake.llm.merkle import LEAF_FIELDS, fold, leaf, manifest, siblings

    docs = table(spark, sf_dir, "documents")
    fields = {c: F.col(c) for c in LEAF_FIELDS}
    tampered = leaf(list({**fields, "text": F.replace("text", F.lit("\n"), F.lit(""))}.values()))
    tampered = F.when(crc_mod(F.col("doc_id"), 2) == 0, tampered).otherwise(leaf(list(fields.values())))
    rows = manifest(docs.withColumn("shown", tampered), ["doc_id", "shown"])
    folded = rows.withColumn("folded_root", fold(F.col("row.shown"), F.col("path")))
    return folded.select(
        "row.doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odolake.llm.divergence import audit

    return audit(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_pii_surrogates": op1_pii_surrogates,
    "op2_mix_sources": op2_mix_sources,
    "op3_decontaminate": op3_decontaminate,
    "op4_license_scan": op4_license_scan,
    "op5_dedup_lines": op5_dedup_lines,
    "op6_toxicity": op6_toxicity,
    "op7_language": op7_language,
    "op8_order_minhash": op8_order_minhash,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_repeated_bytes": op10_repeated_bytes,
    "op11_shards": op11_shards,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_source_divergence": op13_source_divergence,
}
