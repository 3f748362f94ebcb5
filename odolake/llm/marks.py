"""Bitmaps of hashes: a filter of fixed size that goes to every task, so that rows without a partner are not shuffled.

A hash marks one of ``SPOTS`` bits, kept as pages of 4 KB. All pages together are 8 MB at most, whatever the number of
hashes, so they can be broadcast. A row whose bit is not set has no partner; of the others some have none either, the
more the fuller the bitmap is. So a filter saves work and never decides a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from odolake.llm.common import stored

SPOTS = 1 << 26
_PAGE = 1 << 15  # bits of a page


def marks(hashes: DataFrame, store: bool = True) -> DataFrame:
    """(_page, _marks) of the column ``h``; tasks make their own pages first. Pages for one use need no storing."""
    page = F.expr(f"pmod(h, {SPOTS}) div {_PAGE}").alias("_page")
    pages = hashes.groupBy(page).agg(F.bitmap_construct_agg(F.expr(f"pmod(h, {SPOTS}) % {_PAGE}")).alias("_marks"))
    return stored(pages, "marks") if store else pages


def with_mark(df: DataFrame, h: Column, pages: DataFrame, name: str) -> DataFrame:
    """Add ``name``: whether the hash ``h`` may be among those that ``pages`` were made of; a null hash is not."""
    spot = F.pmod(h, F.lit(SPOTS))
    laid = df.withColumn("_spot", spot).withColumn("_page", F.expr(f"_spot div {_PAGE}"))
    laid = laid.join(F.broadcast(pages), "_page", "left")
    byte = F.substring("_marks", F.expr(f"CAST(_spot % {_PAGE} div 8 + 1 AS INT)"), F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (F.col("_spot") % 8).cast("int"))
    return laid.withColumn(name, F.coalesce(bit == 1, F.lit(False))).drop("_spot", "_page", "_marks")


def marked(df: DataFrame, h: Column, pages: DataFrame) -> DataFrame:
    """The rows of ``df`` whose hash may be among those of ``pages``."""
    return with_mark(df, h, pages, "_marked").where("_marked").drop("_marked")
