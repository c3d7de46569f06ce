"""Captured HTML as columns: canonical address and three widths of article text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions import let
from newsloom.functions.reading import read_page
from newsloom.functions.text import tidy_lines
from newsloom.functions.urls import absolutize


def extract_canonical(html: Column, base: Column) -> Column:
    """Address of the first canonical link, else of the `og:url` property; null without one.

    A canonical link without an address does not hand over to a later one.
    """
    return let(read_page(html, "address")["address"], lambda href: absolutize(href, base))


def lines(text: Column) -> Column:
    """Text in clean lines; null if none is left."""
    even = F.regexp_replace(text, r"[ \t]+", " ")
    return F.nullif(F.array_join(tidy_lines(even), "\n"), F.lit(""))


def main_text(html: Column) -> Column:
    """Text of the first article (or main) element, tables and navigation left out; null if none."""
    return lines(read_page(html, "main")["main"])


def readable_text(html: Column) -> Column:
    """Text around the paragraphs that count most; of the body without asides and navigation where there are none; null if none."""
    return lines(read_page(html, "readable")["readable"])


def whole_text(html: Column) -> Column:
    """Text of the whole page, head title included; null if none."""
    return lines(read_page(html, "whole")["whole"])


def extract_best(status: Column, html: Column, retry_html: Column | None = None) -> Column:
    """Struct (text, tier) of the narrowest extraction that is long enough.

    A page with a status other than 200 is only tried through its second capture, if the
    snapshot has one; its tier is named even where no text comes out.
    """
    failed = (status != 0) & (status != 200)
    # A page is parsed once for all widths, and not at all where its status rules it out.
    page = read_page(F.when(~F.coalesce(failed, F.lit(False)), html), "main", "readable", "whole")
    again = main_text(retry_html) if retry_html is not None else F.lit(None).cast("string")

    texts = F.struct(*[lines(page[w]).alias(w) for w in ("main", "readable", "whole")], again.alias("second_capture"))

    def result(text: Column, tier: str | None) -> Column:
        return F.struct(text.alias("text"), F.lit(tier).cast("string").alias("tier"))

    def narrowest(t: Column) -> Column:
        found = result(F.lit(None).cast("string"), None)
        for tier in ("second_capture", "whole", "readable", "main"):
            found = F.when(F.length(t[tier]) > 200, result(t[tier], tier)).otherwise(found)
        return F.when(failed, result(t["second_capture"], "retry")).otherwise(found)

    return let(texts, narrowest)
