"""Text columns: measures, line cleaning, finance placeholders, tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions import any_of, let

# ---- fixed values: finance placeholder rules, in the order they apply ----
# (name, pattern, flags beyond Unicode, replacement)
FINANCE_RULES = (
    ("boilerplate", r"(^read more:.*$|^story continues.*$|copyright\s*©.*$)", "imd", ""),
    ("html_tag", r"<[^>]+>", "", " "),
    ("url", r"https?://\S+|www\.\S+", "", " "),
    ("cashtag", r"\$([A-Za-z]{1,10})\b", "", "__TICKER__"),
    ("quarter", r"\bQ([1-4])\b", "i", "__QTR$1__"),
    ("percent_sign", r"\b[+-]?\d[\d,\.]*\s*%(?=\W|$)", "", "__PERCENT__"),
    ("percent_word", r"\b[+-]?\d[\d,\.]*\s*percent(?=\W|$)", "i", "__PERCENT__"),
    ("per_cent", r"\b[+-]?\d[\d,\.]*\s*per\s+cent(?=\W|$)", "i", "__PERCENT__"),
    ("money", r"(\$|€|£)\s*\d[\d,\.]*\s*(?:bn|b|m|k)?\b", "i", "__MONEY__"),
    ("amount", r"\b\d[\d,\.]*\s*(million|billion|trillion|bn|m)\b", "i", "__AMOUNT__"),
    ("year", r"\b(19|20)\d{2}\b", "", "__YEAR__"),
    (
        "month_day",
        r"\b((jan|feb|mar|apr|may|jun|jul|aug|sep|sept|oct|nov|dec)[a-z]*\s+\d{1,2})\b",
        "i",
        "__DATE__",
    ),
    (
        "day_month",
        r"\b(\d{1,2}\s+(jan|feb|mar|apr|may|jun|jul|aug|sep|sept|oct|nov|dec)[a-z]*)\b",
        "i",
        "__DATE__",
    ),
    ("number", r"(?<![A-Za-z_])\b\d[\d,\.]*\b(?![A-Za-z_])", "", "__NUM__"),
)

# ---- fixed values: typographic characters folded before the rules ----
FOLDED = (("’", "'"), ("“", '"'), ("”", '"'), ("–", "-"), ("—", "-"))

# Texts without any of these strings (in lower case) cannot match the rule. Looking for a
# string is much cheaper than running a pattern, and most texts lack most of them.
RULE_SIGNS = {
    "boilerplate": ("read more:", "story continues", "©"),
    "html_tag": ("<",),
    "url": ("http", "www."),
    "cashtag": ("$",),
    "quarter": ("q1", "q2", "q3", "q4"),
    "percent_sign": ("%",),
    "percent_word": ("percent",),
    "per_cent": ("cent",),
    "money": ("$", "€", "£"),
    "year": ("19", "20"),
}

# ---- fixed values: finance terms that survive token filtering ----
KEEP_TERMS = (
    "uk", "us", "eu", "ai", "ceo", "cfo", "ipo", "esg", "gdp", "cpi", "pmi", "ppi",
    "eps", "roi", "ebitda", "fx", "irr", "yoy", "qoq", "bps", "ev", "iot", "ml",
    "nyse", "nasdaq", "dow", "sp500", "ftse", "dax", "cac", "nikkei", "tsx",
    "hk", "jp", "cn", "in", "br", "mx", "de", "fr", "it", "sg", "za", "kr",
    "gm", "ge", "bp", "ibm", "aapl", "tsla", "msft", "meta", "googl",
    "ons", "imf", "oecd", "ecb", "boe", "fed", "sec", "bis", "opec", "wto", "un",
)

# ---- fixed values: token shapes kept whatever the lexicon says ----
ACRONYM = r"^[A-Z]{2,5}$"
MIXED_CASE = r"^[A-Z0-9&]{2,6}$"

# ---- fixed values: white space and line breaks as the text rules see them ----
WHITESPACE = (
    " \t\n\v\f\r\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
LINE_BREAK = r"[\n\x0B\f\r\x1c-\x1e\x85\u2028\u2029]"

# A run of letters, digits, '&' and '_'; punctuation between them is never kept.
FINANCE_TOKEN = r"[\p{L}\p{N}&_]+"
# Words of two or more characters, the default token of a TF-IDF vectoriser.
WORD = r"[\p{L}\p{N}_]{2,}"


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    return c.isNull() | ~c.rlike(r"(?U)[^\s\x1c-\x1f]")


def text_length(c: Column) -> Column:
    """Length in code points; 0 for null."""
    return F.coalesce(F.length(c), F.lit(0))


def word_count(c: Column) -> Column:
    """Number of pieces between white space; 0 for null."""
    return F.coalesce(F.regexp_count(c, F.lit(r"(?U)[^\s\x1c-\x1f]+")), F.lit(0))


def tidy_lines(c: Column) -> Column:
    """Array of the non-blank lines of a text, stripped."""
    return F.filter(F.transform(F.split(c, LINE_BREAK), strip), lambda line: line != "")


def light_clean(c: Column) -> Column:
    """Strip lines, drop blank and (whatever their case) repeated ones; null for empty text."""

    def first_of_each(by_text: Column) -> Column:
        # Equal lines are neighbours here, the earliest one in front.
        firsts = F.filter(
            by_text, lambda line, i: (i == 0) | (line["low"] != F.get(by_text, i - 1)["low"])
        )
        in_order = F.array_sort(
            F.transform(firsts, lambda line: F.struct(line["place"].alias("place"), line["line"].alias("line")))
        )
        return F.transform(in_order, lambda line: line["line"])

    def once_each(lines: Column) -> Column:
        by_text = F.array_sort(
            F.transform(lines, lambda line, i: F.struct(F.lower(line).alias("low"), i.alias("place"), line.alias("line")))
        )
        # Most texts repeat no line, which a look at the set of lines shows.
        distinct = F.size(F.array_distinct(F.transform(lines, F.lower)))
        return F.when(distinct == F.size(lines), lines).otherwise(let(by_text, first_of_each))

    return F.when(c != "", F.array_join(let(tidy_lines(c), once_each), "\n"))


def collapse_space(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]+", " "))


def fold(c: Column) -> Column:
    """Typographic quotes and dashes as their plain forms."""
    for typographic, plain in FOLDED:
        c = F.replace(c, F.lit(typographic), F.lit(plain))
    return c


def fold_and_lower(c: Column) -> Column:
    return F.lower(fold(c))


def finance_rule(c: Column, name: str) -> Column:
    """One placeholder rule on its own."""
    pattern, flags, replacement = next(rule[1:] for rule in FINANCE_RULES if rule[0] == name)
    return F.regexp_replace(c, f"(?U{flags}){pattern}", replacement)


def normalize_finance(c: Column, lowercase_first: bool = True) -> Column:
    """All placeholder rules in order, white space collapsed; blank or null becomes ''."""

    def rule_where_signs(t: Column, name: str) -> Column:
        signs = RULE_SIGNS.get(name)
        if not signs:
            return finance_rule(t, name)

        def guarded(x: Column) -> Column:
            low = x if lowercase_first else F.lower(x)
            found = any_of([F.contains(low, F.lit(sign)) for sign in signs])
            return F.when(found, finance_rule(x, name)).otherwise(x)

        return let(t, guarded)

    def rules(t: Column, names: list[str]) -> Column:
        for name in names:
            t = rule_where_signs(t, name)
        return t

    names = [rule[0] for rule in FINANCE_RULES]
    first_with_digits = names.index("quarter")
    t = fold_and_lower(c) if lowercase_first else fold(c)
    t = rules(t, names[:first_with_digits])
    t = let(
        t, lambda x: F.when(x.rlike(r"(?U)\d"), rules(x, names[first_with_digits:])).otherwise(x)
    )
    return F.when(is_blank(c), F.lit("")).otherwise(collapse_space(t))


def finance_tokens(c: Column) -> Column:
    """Tokens of a normalised text, placeholders included."""
    return F.regexp_extract_all(c, F.lit(FINANCE_TOKEN), F.lit(0))


def keep_finance_token(token: Column, lemma: Column, is_stop: Column) -> Column:
    """What a token contributes to the cleaned text; null where it is dropped.

    Order matters: a stop word is lost even if it is also a finance term.
    """
    return (
        F.when(token.startswith("__") & token.endswith("__"), token)
        .when(is_stop, F.lit(None).cast("string"))
        .when(lemma.isin(*KEEP_TERMS), lemma)
        .when(token.rlike(f"{ACRONYM}|{MIXED_CASE}"), F.lower(token))
        .when(lemma.rlike(r"^\p{L}{3,}$"), lemma)
    )


def words(c: Column) -> Column:
    """Lower-cased words of at least two characters."""
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))


def ngrams(tokens: Column, low: int = 1, high: int = 2) -> Column:
    """All runs of `low`..`high` neighbouring tokens, joined by a blank."""
    def runs(ts: Column, n: int) -> Column:
        if n == 1:
            return ts
        starts = F.when(F.size(ts) >= n, F.sequence(F.lit(0), F.size(ts) - n))
        return F.coalesce(
            F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(ts, i + k) for k in range(n)])),
            F.array().cast("array<string>"),
        )

    return let(tokens, lambda ts: F.concat(*[runs(ts, n) for n in range(low, high + 1)]))


def counted(items: Column) -> Column:
    """Array of (term, tf): the distinct items of an array and how often they occur."""

    def runs(ordered: Column) -> Column:
        size = F.size(ordered)
        starts = F.filter(
            F.sequence(F.lit(0), size - 1),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )

        def entry(starts: Column, i: Column, k: Column) -> Column:
            end = F.coalesce(F.get(starts, k + 1), size)
            return F.struct(F.get(ordered, i).alias("term"), (end - i).cast("bigint").alias("tf"))

        return let(starts, lambda ss: F.transform(ss, lambda i, k: entry(ss, i, k)))

    return let(F.sort_array(items), lambda ordered: F.when(F.size(ordered) > 0, runs(ordered)))


def letters_only_tokens(c: Column) -> Column:
    """Everything but ASCII letters and white space deleted, lower-cased, split; [] for null."""
    kept = F.lower(F.regexp_replace(c, r"(?U)[^a-zA-Z\s\x1c-\x1f]", ""))
    return F.coalesce(
        F.regexp_extract_all(kept, F.lit(r"(?U)[^\s\x1c-\x1f]+"), F.lit(0)),
        F.array().cast("array<string>"),
    )
