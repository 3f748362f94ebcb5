"""Fields of stored HTML pages. Patterns run over the whole page text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


# Named entities of text, the ampersand last.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def elements(html: Column, tag: str) -> Column:
    """Inner HTML of every ``<tag>`` element, in page order."""
    return F.regexp_extract_all(html, F.lit(rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"), 1)


def first_link(fragment: Column) -> Column:
    return F.nullif(F.regexp_extract(fragment, r'<a\s[^>]*?href="([^"]*)"', 1), F.lit(""))


def _numeric_references(text: Column) -> Column:
    """``&#233;`` and ``&#xE9;`` as their character; a number that is no character stays as it is."""

    def decoded(done: Column, digits: Column) -> Column:
        low = F.lower(digits)
        code = F.when(low.startswith("x"), F.conv(F.substr(low, F.lit(2)), 16, 10)).otherwise(low).try_cast("bigint")
        real = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        sign = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(real, F.replace(done, F.concat(F.lit("&#"), digits, F.lit(";")), sign)).otherwise(done)

    found = F.array_distinct(F.regexp_extract_all(text, F.lit("&#([0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});"), 1))
    return F.aggregate(found, text, decoded)


def inner_text(fragment: Column) -> Column:
    """Text of a fragment without its tags, with named and numeric references decoded."""
    text = F.regexp_replace(fragment, r"(?s)<[^>]*>", "")
    for entity, sign in ENTITIES.items():
        if entity == "&amp;":
            text = _numeric_references(text)
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return F.trim(text)


def _class_with(name: str) -> str:
    """Pattern of a class attribute, in either kind of quotes, with ``name`` as one of its words."""
    inside = [rf"{q}(?:[^{q}]*\s)?{name}(?:\s[^{q}]*)?{q}" for q in ('"', "'")]
    return rf"class\s*=\s*(?:{'|'.join(inside)})"


def has_class(fragment: Column, tag: str, name: str) -> Column:
    return fragment.rlike(rf"<{tag}\s[^>]*?{_class_with(name)}")


def title(html: Column) -> Column:
    return F.nullif(F.regexp_extract(html, r"(?s)<title>(.*?)</title>", 1), F.lit(""))


def attribute(html: Column, tag: str, name: str) -> Column:
    return F.nullif(F.regexp_extract(html, rf'<{tag}\s[^>]*?{name}="([^"]*)"', 1), F.lit(""))


def nth_element_text(html: Column, tag: str, n: Column | int, default: str | None = None) -> Column:
    """Text of the n-th ``<tag>`` element, or the default if the page has fewer."""
    position = n if isinstance(n, Column) else F.lit(n)
    found = inner_text(F.try_element_at(elements(html, tag), position))
    return found if default is None else F.coalesce(found, F.lit(default))


def element_text_by_class(html: Column, tag: str, name: str, default: str = "") -> Column:
    """Text of the first ``<tag class=name>`` element, or the default if there is none."""
    found = F.regexp_extract(html, rf"(?s)<{tag}\s[^>]*?{_class_with(name)}[^>]*>(.*?)</{tag}>", 1)
    return F.coalesce(F.nullif(inner_text(found), F.lit("")), F.lit(default))


def price_text(symbol: Column, whole: Column, cents: Column) -> Column:
    """``symbol whole,cents``; a missing cents part becomes ``00``."""
    return F.concat(symbol, F.lit(" "), whole, F.lit(","), F.coalesce(cents, F.lit("00")))
