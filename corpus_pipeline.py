"""The corpus pipeline: filter, deduplicate, mix and pack documents for training.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and, but for the last, returns
the columns of documents. Between stages the rows are written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.llm import jaccard_join, language, mixing, packing, quality
from newsloom.llm.common import fold
from newsloom.llm.registry import table
from newsloom.operators.joins import lookup_join
from newsloom.session import stored

#: No learned language explains a text that costs more bits a byte than this.
MOST_BITS = 6.0
#: Near copies share this many hundredths of their shingles of so many words (operator 6 by itself takes others).
NEAR_WORDS, NEAR_SHARE = 5, 80


def _aside(docs: DataFrame, *needed: str) -> tuple[DataFrame, list]:
    """`docs` with all but the needed columns under names that no operator uses, and what brings the old ones back."""
    names = [c if c in needed else f"kept_{i}_" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), [F.col(n).alias(c) for n, c in zip(names, docs.columns)]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    own, back = _aside(docs, "doc_id", "text")
    return quality.scored(own, quality.learn(own, labels)).where("predicted = 1").select(*back)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; texts without a letter are in none."""
    own, back = _aside(docs, "doc_id", "text", "lang")
    told = language.identify(own)
    return told.where((F.col("lang_pred") != language.UND) & (F.col("bits_per_byte") <= MOST_BITS)).select(*back)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by their shingles the one with the least (id, hash of the text), null ids last; every row that links with nothing.

    Rows without a shingle all stay. Of rows equal in id and text one of a group stays. What goes is looked up by id and hash of
    the text, so texts are not sorted, and not moved either while the list of what goes is short enough to send round.
    """
    own, back = _aside(docs, "doc_id", "text")
    key = {"none_": F.col("doc_id").isNull(), "id_": F.coalesce("doc_id", F.lit(0)), "hash_": F.xxhash64("text")}
    linked = jaccard_join.linked_documents(own, width=NEAR_WORDS, share=NEAR_SHARE).where("n > 0")
    told = linked.select("root", F.struct(key["none_"].alias("none_"), key["id_"].alias("id_"), F.col("text_hash").alias("hash_")).alias("key"))
    told = stored(told.groupBy("root", "key").agg(F.count(F.lit(1)).alias("rows")), "rows-of-groups")
    first = told.groupBy("root").agg(F.min("key").alias("first"))
    marked = stored(told.join(first, "root").select("key.*", (F.col("key") == F.col("first")).alias("first"), "rows"), "first-of-groups")
    gone, repeated = (stored(marked.where(which).select(*key), name) for which, name in (("not first", "gone"), ("first and rows > 1", "repeated")))
    mark = lambda table, name: table.distinct().withColumn(name, F.lit(True))
    rows = own.withColumns(key)
    for table, name in ((gone, "gone_"), (repeated, "repeated_")):
        rows = lookup_join(rows, mark(table, name), list(key), ["doc_id", "hash_"])
    kept = rows.where(F.col("gone_").isNull())
    place = F.row_number().over(Window.partitionBy(*key).orderBy("id_"))
    once = kept.where("repeated_").withColumn("place_", place).where("place_ = 1").drop("place_")
    return kept.where(F.col("repeated_").isNull()).unionByName(once).select(*back)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    own, back = _aside(docs, "doc_id", "text", "source")
    mixed = mixing.mix(own).where("copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*back)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of full length."""
    import public_tokenizers

    pieces = packing.pack(docs, public_tokenizers.path(packing.TOKENIZER))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality classifier", keep_good),
    ("language ID", keep_known_languages),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("mixing sources", mix),
    ("packing", pack),
]

#: No SQL: learned models and links between documents decide.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
