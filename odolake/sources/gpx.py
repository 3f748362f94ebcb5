"""GPX documents as point rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

GPX_SCHEMA = (
    "trk ARRAY<STRUCT<name: STRING, trkseg: ARRAY<STRUCT<trkpt: ARRAY<STRUCT<"
    "_lat: DOUBLE, _lon: DOUBLE, ele: DOUBLE, time: STRING>>>>>>, _corrupt_record STRING"
)


def read_gpx(spark: SparkSession, path: str, packed: bool = False) -> DataFrame:
    """One row per ``<gpx>`` document with its file name; ``.gpx.gz`` files are read as they are.

    A broken document gives a row with only ``_corrupt_record``. ``packed`` is for files that hold
    many documents, one per line; those files are split between tasks.
    """
    return (
        spark.read.format("xml")
        .option("rowTag", "gpx")
        .option("mode", "PERMISSIVE")
        .option("multiLine", not packed)
        .schema(GPX_SCHEMA)
        .load(path)
        .withColumn("file_name", F.col("_metadata.file_name"))
    )


def parse_gpx(df: DataFrame, body: str) -> DataFrame:
    """The same columns from a table that stores one document per row as text."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = df.withColumn("_gpx", F.from_xml(body, GPX_SCHEMA, options))
    return parsed.withColumns({"trk": F.col("_gpx.trk"), "_corrupt_record": F.col("_gpx._corrupt_record")}).drop(
        "_gpx", body
    )


def intact(documents: DataFrame) -> DataFrame:
    return documents.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def quarantine(documents: DataFrame) -> DataFrame:
    """Broken documents with their text and the number of tracks that could still be read."""
    tracks = F.when(F.col("trk").isNull(), 0).otherwise(F.size("trk"))
    return documents.where(F.col("_corrupt_record").isNotNull()).withColumn("tracks_read", tracks).drop("trk")


def _file_order() -> Column:
    """Whole number that follows the file order of tracks, segments and points."""
    track = F.col("trk_idx").cast("bigint") * F.lit(1 << 48)
    segment = F.col("seg_idx").cast("bigint") * F.lit(1 << 32)
    return track + segment + F.col("pt_idx")


def points(documents: DataFrame, keep: list[str] = ("file_name",)) -> DataFrame:
    """Flatten tracks, segments and points; missing elevation or time stays null."""
    keep = list(keep)
    return (
        documents.select(*keep, F.posexplode("trk").alias("trk_idx", "_trk"))
        .select(*keep, "trk_idx", F.col("_trk.name").alias("trk_name"), F.posexplode("_trk.trkseg").alias("seg_idx", "_seg"))
        .select(*keep, "trk_idx", "trk_name", "seg_idx", F.posexplode("_seg.trkpt").alias("pt_idx", "_pt"))
        .select(
            *keep,
            "trk_name",
            "trk_idx",
            "seg_idx",
            "pt_idx",
            _file_order().alias("seq"),
            F.col("_pt._lat").alias("latitude"),
            F.col("_pt._lon").alias("longitude"),
            F.col("_pt.ele").alias("elevacao"),
            F.col("_pt.time").alias("time_point"),
        )
    )
