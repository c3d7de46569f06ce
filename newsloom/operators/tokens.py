"""Tokens against lookup tables: cleaned texts, lemmas, bags of words."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import let
from newsloom.functions.text import (
    counted,
    finance_tokens,
    keep_finance_token,
    letters_only_tokens,
    normalize_finance,
)
from newsloom.operators.joins import is_small, lookup_join

INLINE_ROWS = 200
#: Bytes of text whose tokens are grouped in one task.
PART_BYTES = 16 << 20


def _lexicon(lexicon: DataFrame) -> DataFrame:
    """One lemma per form, the first by name; entries without a form or lemma say nothing."""
    known = lexicon.where(F.col("form").isNotNull() & F.col("lemma").isNotNull())
    return known.groupBy("form").agg(F.min("lemma").alias("lemma"))


def _stop_list(stopwords: DataFrame) -> DataFrame:
    return stopwords.select("word").where(F.col("word").isNotNull()).distinct()


def _inline(df: DataFrame, most: int) -> list | None:
    """The rows of a short lookup table; None for a longer one, which is joined instead."""
    rows = df.limit(most + 1).collect()
    return rows if len(rows) <= most else None


def _lemma_inline(lexicon_rows: list) -> Callable[[Column], Column]:
    if not lexicon_rows:
        return lambda t: t
    pairs = [F.lit(v) for row in lexicon_rows for v in (row["form"], row["lemma"])]
    table = F.create_map(*pairs)
    return lambda t: F.coalesce(F.try_element_at(table, t), t)


def _with_lemma(tokens: DataFrame, forms: DataFrame, spread_by: list[str]) -> DataFrame:
    """Add `lemma` to a table of single tokens."""
    known = forms.select(F.col("form").alias("token"), F.col("lemma").alias("known"))
    joined = lookup_join(tokens, known, ["token"], spread_by)
    return joined.withColumn("lemma", F.coalesce("known", "token")).drop("known")


def _with_stop_mark(tokens: DataFrame, stops: DataFrame, key: str, spread_by: list[str]) -> DataFrame:
    """Add `is_stop`, whether column `key` is a stop word."""
    marks = stops.select(F.col("word").alias(key), F.lit(True).alias("is_stop"))
    joined = lookup_join(tokens, marks, [key], spread_by)
    return joined.withColumn("is_stop", F.coalesce("is_stop", F.lit(False)))


def clean_tokens(
    df: DataFrame,
    row_id: str,
    col: str,
    lexicon: DataFrame,
    stopwords: DataFrame,
    name: str = "text_nc",
    inline_rows: int = INLINE_ROWS,
) -> DataFrame:
    """Add the text of the lemmas worth keeping, in order, joined by blanks.

    `lexicon` (form, lemma) and `stopwords` (word) are inputs; of a repeated form the first
    lemma by name counts. Short tables are applied inside the row; longer ones are joined to the
    tokens, which are then put together again where their texts were placed.
    """
    forms, stops = _lexicon(lexicon), _stop_list(stopwords)
    lexicon_rows, stop_rows = _inline(forms, inline_rows), _inline(stops, inline_rows)
    if lexicon_rows is not None and stop_rows is not None:
        lemma_of = _lemma_inline(lexicon_rows)
        stop = [row["word"] for row in stop_rows]

        def kept(token: Column) -> Column:
            return let(
                F.lower(lemma_of(token)),
                lambda lemma: keep_finance_token(token, lemma, lemma.isin(*stop) if stop else F.lit(False)),
            )

        tokens = F.filter(F.transform(finance_tokens(F.col(col)), kept), lambda t: t.isNotNull())
        return df.withColumn(name, F.array_join(tokens, " "))

    spread = [row_id, "pos"]
    placed = df.repartition(row_id)
    tokens = placed.select(row_id, F.posexplode(finance_tokens(F.col(col))).alias("pos", "token"))
    tokens = _with_lemma(tokens, forms, spread).withColumn("lemma", F.lower("lemma"))
    tokens = _with_stop_mark(tokens, stops, "lemma", spread)
    tokens = tokens.withColumn("kept", keep_finance_token(F.col("token"), F.col("lemma"), F.col("is_stop")))
    texts = tokens.where(F.col("kept").isNotNull()).groupBy(row_id).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("pos", "kept"))), lambda p: p["kept"]), " "
        ).alias(name)
    )
    return placed.join(texts, row_id, "left").withColumn(name, F.coalesce(name, F.lit("")))


def add_normalized(
    df: DataFrame,
    row_id: str,
    col: str,
    lexicon: DataFrame,
    stopwords: DataFrame,
    inline_rows: int = INLINE_ROWS,
) -> DataFrame:
    """Add text_nc_step1 (placeholders) and text_nc (cleaned tokens)."""
    step1 = df.withColumn("text_nc_step1", normalize_finance(F.col(col)))
    return clean_tokens(step1, row_id, "text_nc_step1", lexicon, stopwords, "text_nc", inline_rows)


def tokenize_lemmatize(df: DataFrame, row_id: str, col: str, lexicon: DataFrame) -> DataFrame:
    """One row per token: row_id, pos, token, lemma; letters only, lower case."""
    tokens = df.select(row_id, F.posexplode(letters_only_tokens(F.col(col))).alias("pos", "token"))
    return _with_lemma(tokens, _lexicon(lexicon), [row_id, "pos"])


def _parts(df: DataFrame, col: str) -> int:
    """How many parts of `PART_BYTES` the texts make (measured), at least as many as the session's shuffles."""
    size = df.agg(F.sum(F.octet_length(col))).first()[0] or 0
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))


def bag_of_words(
    df: DataFrame,
    row_id: str,
    col: str,
    lexicon: DataFrame,
    stopwords: DataFrame,
    inline_rows: int = INLINE_ROWS,
) -> DataFrame:
    """(row_id, term, cnt) of the lemmas that are not stop words; `row_id` tells rows apart.

    With short lookup tables a text is counted inside its row and nothing moves. With longer
    ones texts move once, whole, and the counts of a text then need no further shuffle; where a table is too long to send, the
    tokens move instead. Either way they are dealt to parts by the size of all texts, so a task groups no more of larger inputs.
    """
    forms, stops = _lexicon(lexicon), _stop_list(stopwords)
    lexicon_rows, stop_rows = _inline(forms, inline_rows), _inline(stops, inline_rows)
    if lexicon_rows is not None and stop_rows is not None:
        lemmas = F.transform(letters_only_tokens(F.col(col)), _lemma_inline(lexicon_rows))
        stop = [row["word"] for row in stop_rows]
        terms = F.filter(lemmas, lambda t: ~t.isin(*stop)) if stop else lemmas
        return df.select(row_id, F.inline(counted(terms))).withColumnRenamed("tf", "cnt")
    parts, texts = _parts(df, col), df.select(row_id, col)
    sent = is_small(forms) and is_small(stops)
    tokens = tokenize_lemmatize(texts.repartition(parts, row_id) if sent else texts, row_id, col, lexicon)
    marked = _with_stop_mark(tokens, stops, "lemma", [row_id, "pos"])
    if not sent:
        marked = marked.repartition(parts, row_id)
    return (
        marked.where(~F.col("is_stop"))
        .groupBy(row_id, F.col("lemma").alias("term"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
