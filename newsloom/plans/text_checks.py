"""Checked queries on text normalisation and tokens."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom.functions import text as tx
from newsloom.operators import lemmas as lm
from newsloom.operators import tokens as tk
from newsloom.operators.tfidf import document_terms, TfidfConfig
from newsloom.plans.catalog import checked
from newsloom.plans.views import view
from newsloom.session import stored

NEWS = ("news",)

LOWERED = "lower(translate(article_text, '’“”–—', '''\"\"--'))"
MONTHS = "(jan|feb|mar|apr|may|jun|jul|aug|sep|sept|oct|nov|dec)[a-z]*"

# The rules again in a dialect without look-around: what a look-ahead tests is captured
# and put back.
RULES_SQL = {
    "boilerplate": (r"(?im)(^read more:.*$|^story continues.*$|copyright\s*©.*$)", ""),
    "html_tag": ("<[^>]+>", " "),
    "url": (r"https?://\S+|www\.\S+", " "),
    "cashtag": (r"\$([A-Za-z]{1,10})\b", "__TICKER__"),
    "quarter": (r"(?i)\bQ([1-4])\b", r"__QTR\1__"),
    "percent_sign": (r"\b[+-]?\d[\d,\.]*\s*%(\W|$)", r"__PERCENT__\1"),
    "percent_word": (r"(?i)\b[+-]?\d[\d,\.]*\s*percent(\W|$)", r"__PERCENT__\1"),
    "per_cent": (r"(?i)\b[+-]?\d[\d,\.]*\s*per\s+cent(\W|$)", r"__PERCENT__\1"),
    "money": (r"(?i)(\$|€|£)\s*\d[\d,\.]*\s*(?:bn|b|m|k)?\b", "__MONEY__"),
    "amount": (r"(?i)\b\d[\d,\.]*\s*(million|billion|trillion|bn|m)\b", "__AMOUNT__"),
    "year": (r"\b(19|20)\d{2}\b", "__YEAR__"),
    "month_day": (rf"(?i)\b({MONTHS}\s+\d{{1,2}})\b", "__DATE__"),
    "day_month": (rf"(?i)\b(\d{{1,2}}\s+{MONTHS})\b", "__DATE__"),
    "number": (r"\b\d[\d,\.]*\b([^A-Za-z_]|$)", r"__NUM__\1"),
}


def _replaced(c: str, name: str) -> str:
    pattern, replacement = RULES_SQL[name]
    return f"regexp_replace({c}, '{pattern}', '{replacement}', 'g')"


def _normalized(c: str = LOWERED) -> str:
    for name in RULES_SQL:
        c = _replaced(c, name)
    return f"CASE WHEN regexp_matches(article_text, '\\S') THEN trim(regexp_replace({c}, '\\s+', ' ', 'g')) ELSE '' END"


@checked("fold_and_lower", f"SELECT doc_id, {LOWERED} AS text FROM news", NEWS)
def _fold_and_lower(spark, sf):
    return view(spark, sf, "news").select("doc_id", tx.fold_and_lower(F.col("article_text")).alias("text"))


for _rule in RULES_SQL:

    @checked(f"rule_{_rule}", f"SELECT doc_id, {_replaced(LOWERED, _rule)} AS text FROM news", NEWS)
    def _one_rule(spark, sf, rule=_rule):
        low = tx.fold_and_lower(F.col("article_text"))
        return view(spark, sf, "news").select("doc_id", tx.finance_rule(low, rule).alias("text"))


@checked(
    "collapse_white_space",
    "SELECT doc_id, trim(regexp_replace(article_text, '\\s+', ' ', 'g')) AS text FROM news",
    NEWS,
)
def _collapse_white_space(spark, sf):
    return view(spark, sf, "news").select("doc_id", tx.collapse_space(F.col("article_text")).alias("text"))


@checked("normalize_finance", f"SELECT doc_id, {_normalized()} AS text_nc_step1 FROM news", NEWS)
def _normalize_finance(spark, sf):
    return view(spark, sf, "news").select(
        "doc_id", tx.normalize_finance(F.col("article_text")).alias("text_nc_step1")
    )


KEEP_SQL = ", ".join(f"'{t}'" for t in tx.KEEP_TERMS)
CLEAN_SQL = f"""step AS (SELECT doc_id, article_text, {_normalized()} AS step1 FROM news),
  toks AS (SELECT doc_id, unnest(t) AS tok, generate_subscripts(t, 1) AS pos FROM (
    SELECT doc_id, regexp_extract_all(step1, '[\\p{{L}}\\p{{N}}&_]+|[^\\p{{L}}\\p{{N}}&_\\s]') AS t FROM step) x),
  lemmas AS (SELECT k.*, lower(coalesce(l.lemma, k.tok)) AS lemma FROM toks k LEFT JOIN lexicon l ON l.form = k.tok),
  kept AS (SELECT m.doc_id, m.pos, CASE
      WHEN m.tok LIKE '\\_\\_%\\_\\_' ESCAPE '\\' OR m.tok IN ('__', '___') THEN m.tok
      WHEN NOT regexp_matches(m.tok, '[\\p{{L}}\\p{{N}}&_]') THEN NULL
      WHEN s.word IS NOT NULL THEN NULL
      WHEN m.lemma IN ({KEEP_SQL}) THEN m.lemma
      WHEN regexp_full_match(m.tok, '[A-Z]{{2,5}}|[A-Z0-9&]{{2,6}}') THEN lower(m.tok)
      WHEN regexp_full_match(m.lemma, '\\p{{L}}{{3,}}') THEN m.lemma END AS kept
    FROM lemmas m LEFT JOIN stopwords s ON s.word = m.lemma),
  cleaned AS (SELECT doc_id, string_agg(kept, ' ' ORDER BY pos) AS text_nc FROM kept WHERE kept IS NOT NULL GROUP BY doc_id)"""
CLEANED_SQL = f"""{CLEAN_SQL}
  SELECT s.doc_id, s.step1 AS text_nc_step1, coalesce(c.text_nc, '') AS text_nc FROM step s LEFT JOIN cleaned c ON c.doc_id = s.doc_id"""


@checked("clean_tokens", CLEANED_SQL, ("news", "lexicon", "stopwords"))
def _clean_tokens(spark, sf):
    news = view(spark, sf, "news").select("doc_id", "article_text")
    done = tk.add_normalized(news, "doc_id", "article_text", view(spark, sf, "lexicon"), view(spark, sf, "stopwords"))
    return done.drop("article_text")


@checked("clean_tokens_by_join", CLEANED_SQL, ("news", "lexicon", "stopwords"))
def _clean_tokens_by_join(spark, sf):
    news = view(spark, sf, "news").select("doc_id", "article_text")
    done = tk.add_normalized(
        news, "doc_id", "article_text", view(spark, sf, "lexicon"), view(spark, sf, "stopwords"), inline_rows=0
    )
    return done.drop("article_text")


# Of a repeated form the first lemma by name counts, and entries with a gap say nothing.
ONE_EACH_SQL = """lexicon AS (SELECT form, min(lemma) AS lemma FROM lexicon_repeats WHERE form IS NOT NULL AND lemma IS NOT NULL GROUP BY form),
  stopwords AS (SELECT DISTINCT word FROM stopwords_repeats WHERE word IS NOT NULL), """
REPEATS = ("news", "lexicon_repeats", "stopwords_repeats")


def _one_each(sql: str) -> str:
    """`sql` with the repeated tables reduced; the plain ones go by other names there."""
    return ONE_EACH_SQL.replace("lexicon AS", "one_lexicon AS").replace("stopwords AS", "one_stopwords AS") + sql.replace(
        "JOIN lexicon l", "JOIN one_lexicon l"
    ).replace("JOIN stopwords s", "JOIN one_stopwords s").replace("FROM stopwords)", "FROM one_stopwords)")


for _route, _rows in (("", 200), ("_by_join", 0)):

    @checked(f"clean_tokens_repeated_forms{_route}", _one_each(CLEANED_SQL), REPEATS)
    def _clean_tokens_repeated(spark, sf, rows=_rows):
        news = view(spark, sf, "news").select("doc_id", "article_text")
        lexicon, stops = view(spark, sf, "lexicon_repeats"), view(spark, sf, "stopwords_repeats")
        return tk.add_normalized(news, "doc_id", "article_text", lexicon, stops, inline_rows=rows).drop("article_text")


LEMMA_SQL = """letters AS (SELECT doc_id, lower(regexp_replace(article_text, '[^a-zA-Z\\s]', '', 'g')) AS t FROM news WHERE article_text IS NOT NULL),
  toks AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS pos FROM (SELECT doc_id, regexp_extract_all(t, '\\S+') AS w FROM letters) x),
  lemmas AS (SELECT k.doc_id, k.pos, k.token, coalesce(l.lemma, k.token) AS lemma FROM toks k LEFT JOIN lexicon l ON l.form = k.token)"""


@checked(
    "tokenize_lemmatize",
    f"{LEMMA_SQL} SELECT doc_id, pos::INTEGER AS pos, token, lemma FROM lemmas",
    ("news", "lexicon"),
)
def _tokenize_lemmatize(spark, sf):
    return tk.tokenize_lemmatize(view(spark, sf, "news"), "doc_id", "article_text", view(spark, sf, "lexicon"))


BAG_SQL = f"""{LEMMA_SQL} SELECT doc_id, lemma AS term, count(*) AS cnt FROM lemmas
    WHERE lemma NOT IN (SELECT word FROM stopwords) GROUP BY doc_id, lemma"""

for _route, _rows in (("", 200), ("_by_join", 0)):

    @checked(f"bag_of_words_repeated_forms{_route}", _one_each(BAG_SQL), REPEATS)
    def _bag_repeated(spark, sf, rows=_rows):
        lexicon, stops = view(spark, sf, "lexicon_repeats"), view(spark, sf, "stopwords_repeats")
        return tk.bag_of_words(view(spark, sf, "news"), "doc_id", "article_text", lexicon, stops, inline_rows=rows)


@checked("bag_of_words", BAG_SQL, ("news", "lexicon", "stopwords"))
def _bag_of_words(spark, sf):
    return tk.bag_of_words(
        view(spark, sf, "news"), "doc_id", "article_text", view(spark, sf, "lexicon"), view(spark, sf, "stopwords")
    )


WORDS_SQL = """words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM (
    SELECT doc_id, regexp_extract_all(lower(article_text), '[\\p{L}\\p{N}_]{2,}') AS w FROM news WHERE regexp_matches(article_text, '\\S')) x),
  grams AS (SELECT doc_id, word AS term FROM words UNION ALL
    SELECT doc_id, word || ' ' || following FROM (SELECT doc_id, word, lead(word) OVER (PARTITION BY doc_id ORDER BY pos) AS following FROM words) y WHERE following IS NOT NULL),
  tf AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY doc_id, term)"""


@checked("ngram_counts", f"{WORDS_SQL} SELECT doc_id, term, tf FROM tf", NEWS)
def _ngram_counts(spark, sf):
    return document_terms(view(spark, sf, "news"), "doc_id", "article_text", TfidfConfig())


# ---------------------------------------------------------------- lemmas by rule

# Words of the texts stand for nouns; planted forms of each need every rule, two turns of them, an exception, or come to nothing.
PLANTED_FORMS = ("{n} || 's'", "{n} || 'es'", "{n} || 'ses'", "{n} || 'sss'", "{n} || 'men'", "{n} || 'en'", "regexp_replace({n}, 'y$', 'ies')", "regexp_replace({n}, 'f$', 'ves')", "'zq' || {n} || 'shes'")
NOUN_SQL = "SELECT DISTINCT token AS lemma FROM {tokens} WHERE length(token) BETWEEN 3 AND 9 AND token NOT LIKE '%s' UNION SELECT DISTINCT token || 'man' FROM {tokens} WHERE length(token) = 6 AND token NOT LIKE '%s'"
FORM_SQL = "SELECT DISTINCT token AS form FROM {tokens} UNION " + " UNION ".join(f"SELECT {f.format(n='lemma')} FROM nouns" for f in PLANTED_FORMS)
EXCEPTION_SQL = "SELECT lemma || 'en' AS form, lemma FROM nouns WHERE length(lemma) = 4 UNION SELECT lemma || 's', 'nowhere' FROM nouns WHERE length(lemma) = 5"
RULES_SQL = ", ".join(f"('{old}', '{new}')" for old, new in lm.RULES)


@checked(
    "noun_lemmas",
    f"""{LEMMA_SQL}, nouns AS ({NOUN_SQL.format(tokens='toks')}), forms AS ({FORM_SQL.format(tokens='toks')}), exceptions AS ({EXCEPTION_SQL}),
  rules AS (SELECT * FROM (VALUES {RULES_SQL}) AS t(old, new)),
  made AS (SELECT f.form, left(f.form, length(f.form) - length(r.old)) || r.new AS candidate, 1 AS turn FROM forms f JOIN rules r ON ends_with(f.form, r.old)
      WHERE f.form NOT IN (SELECT form FROM exceptions)
    UNION SELECT m.form, left(m.candidate, length(m.candidate) - length(r.old)) || r.new, m.turn + 1 FROM made m JOIN rules r ON ends_with(m.candidate, r.old)),
  tried AS (SELECT * FROM made UNION SELECT form, form, 1 FROM forms UNION SELECT form, lemma, 1 FROM exceptions),
  found AS (SELECT *, row_number() OVER (PARTITION BY form ORDER BY turn, length(candidate), candidate) AS r FROM tried WHERE candidate IN (SELECT lemma FROM nouns) AND form IN (SELECT form FROM forms))
  SELECT form, candidate AS lemma FROM found WHERE r = 1 AND candidate <> form""",
    ("news", "lexicon"),
)
def _noun_lemmas(spark, sf):
    tokens = stored(tk.tokenize_lemmatize(view(spark, sf, "news"), "doc_id", "article_text", view(spark, sf, "lexicon")).select("token").distinct(), "tokens")
    tokens.createOrReplaceTempView("newsloom_tokens")
    nouns = NOUN_SQL.format(tokens="newsloom_tokens")
    forms, exceptions = (spark.sql(f"WITH nouns AS ({nouns}) {q}") for q in (FORM_SQL.format(tokens="newsloom_tokens"), EXCEPTION_SQL))
    return lm.noun_lexicon(forms, spark.sql(nouns), exceptions)
