"""Stored web pages as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from odolake.functions import markup


def link_rows(
    pages: DataFrame,
    keep: list[str],
    prefix: str,
    tag: str = "tr",
    pending: Column | None = None,
    pending_class: str = "text-danger",
) -> DataFrame:
    """One row per ``<tag>`` element with a link: absolute URL and the pending flag.

    ``pending`` is a predicate on the column ``fragment`` (the element's inner HTML); by default
    an element is pending when it holds a ``<span>`` of the class ``pending_class``.
    """
    flag = pending if pending is not None else markup.has_class(F.col("fragment"), "span", pending_class)
    return (
        pages.select(*keep, F.posexplode(markup.elements(F.col("html"), tag)).alias("pos", "fragment"))
        .withColumns({"_href": markup.first_link(F.col("fragment")), "pending": flag})
        .where(F.col("_href").isNotNull())
        .select(*keep, "pos", F.concat(F.lit(prefix), F.col("_href")).alias("url"), "pending")
    )


def field_by_state(html: Column, pending: Column, tag: str = "tr", pending_row: int = 4, done_row: int = 6) -> Column:
    """Text of an element whose position on the page depends on the pending state."""
    return markup.nth_element_text(html, tag, F.when(pending, F.lit(pending_row)).otherwise(F.lit(done_row)))
