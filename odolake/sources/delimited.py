"""Delimited files: ``;`` by default, with a header line and a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def read_delimited(
    spark: SparkSession, path: str, schema: str, sep: str = ";", encoding: str = "UTF-8", suffix: str = ".csv"
) -> DataFrame:
    """All files of a folder that end in ``suffix``, as one table."""
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", True)
        .option("encoding", encoding)
        .option("pathGlobFilter", f"*{suffix}")
        .csv(path)
    )


def sheet_lines(spark: SparkSession, path: str, skip: int = 9) -> DataFrame:
    """(file_name, line, text) of the data lines of sheet exports: all after ``skip`` preamble lines and a header line.

    Files are read in splits. The lines of a split are numbered as they are read, and the lines of the splits before it
    in its file are added, one row per split, so neither a large file nor its preamble needs to be in one task.
    """
    read = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
        F.col("value").alias("text"),
    )
    splits = read.groupBy("_file", "_start").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")
    numbered = read.join(splits.select("_file", "_start", shift.alias("_shift")), ["_file", "_start"])
    numbered = numbered.withColumn("line", F.col("_id") + F.col("_shift"))
    data = numbered.where((F.col("line") > skip) & (F.trim("text") != ""))
    return data.select(F.element_at(F.split("_file", "/"), -1).alias("file_name"), "line", "text")


_BAD = "_unreadable"


def _parsed(lines: DataFrame, schema: str, sep: str) -> DataFrame:
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    return lines.withColumn("_r", F.from_csv("text", F.lit(f"{schema}, {_BAD} STRING"), options))


def sheet_rows(lines: DataFrame, schema: str, sep: str = ";") -> DataFrame:
    return _parsed(lines, schema, sep).where(F.col(f"_r.{_BAD}").isNull()).select("_r.*").drop(_BAD)


def sheet_rejects(lines: DataFrame, schema: str, sep: str = ";") -> DataFrame:
    """Lines that do not fit the schema, by number of fields or by type, as they are in the file."""
    return _parsed(lines, schema, sep).where(F.col(f"_r.{_BAD}").isNotNull()).drop("_r")


def read_sheet_export(spark: SparkSession, path: str, schema: str, skip: int = 9, sep: str = ";") -> DataFrame:
    """The rows of sheet exports; see ``sheet_rejects`` for the lines left out."""
    return sheet_rows(sheet_lines(spark, path, skip), schema, sep)
