"""Validity of texts and fetches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions import any_of, let
from newsloom.functions.text import is_blank
from newsloom.functions.urls import is_blacklisted, is_http_url

# ---- fixed values: phrases that mark a failed or partial extraction ----
ARTEFACTS = {
    "basic": (
        "oops, something went wrong",
        "all rights reserved.",
        "terms and privacy policy",
        "my portfolio",
        "watch now",
        "min read",
        "scott lehtonen",
        "patrick seitz",
    ),
    "strict": (
        "oops, something went wrong",
        "all rights reserved.",
        "terms and privacy policy",
        "my portfolio",
        "watch now",
        "min read",
        "scott lehtonen",
        "patrick seitz",
        "- my portfolio",
        "copyright",
    ),
}

# ---- fixed values: phrases of consent and block pages ----
CONSENT = (
    r"Yahoo is part of the Yahoo family of brands",
    r"Will be right back",
    r"enable JavaScript and cookies",
    r"before continuing",
)
CONSENT_WINDOW = 20_000  # such pages say so at the top; later mentions are article text


def is_good_text(c: Column, min_len: int = 100, artefacts: str = "basic") -> Column:
    """Long enough and free of extraction artefacts; null is not good."""

    def clean(low: Column) -> Column:
        return ~any_of([F.contains(low, F.lit(a)) for a in ARTEFACTS[artefacts]])

    # Texts are lower-cased once, and only if they are long enough.
    return c.isNotNull() & (F.length(c) >= min_len) & let(F.lower(c), clean)


def looks_like_consent(html: Column, chars: int | None = CONSENT_WINDOW) -> Column:
    """Whether the first `chars` characters (None: the whole page) hold a phrase of consent pages."""
    top = html if chars is None else F.substring(html, 1, chars)
    return F.coalesce(top.rlike("(?iU)" + "|".join(CONSENT)), F.lit(False))


def fetch_error(
    url: Column, status: Column, html: Column, error: Column | None = None, consent_chars: int | None = CONSENT_WINDOW
) -> Column:
    """Why a fetch is not a plain success; null if it is."""
    why = (
        F.when(~is_http_url(url), F.lit("invalid_url"))
        .when(is_blacklisted(url), F.lit("blacklisted_domain"))
    )
    if error is not None:
        why = why.when(error.isNotNull(), error)
    return (
        why.when(status.isNull(), F.lit("fetch_error:NotCaptured:no page captured"))
        .when(status == 0, F.lit("fetch_error:NoResponse:no response captured"))
        .when(status != 200, F.concat(F.lit("http_status_"), status.cast("string")))
        .when(looks_like_consent(html, consent_chars), F.lit("consent_or_block_detected"))
    )


def derive_http_code(error: Column, status: Column, text: Column) -> Column:
    """Three-digit word of the error text, else a valid status, else a guess from the text."""
    named = F.regexp_extract(error, r"(?U)\b([0-9]{3})\b", 1)
    number = status.cast("int")
    return (
        F.when(named != "", named.try_cast("int"))
        .when(number.between(100, 599), number)
        .when(is_blank(text), F.lit(0))
        .otherwise(F.lit(200))
    )
