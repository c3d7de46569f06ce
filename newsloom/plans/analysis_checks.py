"""Checked queries on TF-IDF, similarity and topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom.operators import nmf, reports
from newsloom.operators import tfidf as tf
from newsloom.operators import tokens as tk
from newsloom.operators import topics as tp
from newsloom.plans.catalog import checked
from newsloom.plans.text_checks import LEMMA_SQL, WORDS_SQL
from newsloom.plans.views import view
from newsloom.session import scratch_dir, stored

NEWS = ("news",)

# ---------------------------------------------------------------- TF-IDF


def _model_sql(max_features: int | None = None) -> str:
    cut = f"ORDER BY cf DESC, term LIMIT {max_features}" if max_features else ""
    return f"""{WORDS_SQL},
  n AS (SELECT count(*) AS n FROM news WHERE regexp_matches(article_text, '\\S')),
  stats AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM tf GROUP BY term),
  chosen AS (SELECT * FROM stats WHERE df >= 3 AND df <= 0.9 * (SELECT n FROM n) {cut}),
  vocab AS (SELECT row_number() OVER (ORDER BY term) - 1 AS term_id, term, df, cf, ln((1 + (SELECT n FROM n)) / (1 + df)::DOUBLE) + 1 AS idf FROM chosen),
  raw AS (SELECT t.doc_id, v.term_id, v.term, t.tf * v.idf AS raw FROM tf t JOIN vocab v ON v.term = t.term),
  cells AS (SELECT r.doc_id, r.term_id, r.term, r.raw / l.length AS weight FROM raw r
    JOIN (SELECT doc_id, sqrt(sum(raw * raw)) AS length FROM raw GROUP BY doc_id) l ON l.doc_id = r.doc_id)"""


FULL = _model_sql()


def _fit(spark, sf, config=None):
    # The fit deals the texts itself.
    news = view(spark, sf, "news", dealt=False).select("doc_id", "article_text")
    return tf.fit_tfidf(news, "doc_id", "article_text", config), news


@checked("tfidf_vocabulary", f"{FULL} SELECT term_id, term, df, cf, round(idf, 6) AS idf FROM vocab", NEWS)
def _tfidf_vocabulary(spark, sf):
    model, _ = _fit(spark, sf)
    return model.vocabulary.withColumn("idf", F.round("idf", 6))


@checked(
    "tfidf_vocabulary_cut",
    f"{_model_sql(12_000)} SELECT term_id, term, df, cf, round(idf, 6) AS idf FROM vocab",
    NEWS,
)
def _tfidf_vocabulary_cut(spark, sf):
    model, _ = _fit(spark, sf, tf.TfidfConfig(max_features=12_000))
    return model.vocabulary.withColumn("idf", F.round("idf", 6))


@checked("tfidf_weights", f"{FULL} SELECT doc_id, term_id, term, round(weight, 6) AS weight FROM cells", NEWS)
def _tfidf_weights(spark, sf):
    model, news = _fit(spark, sf)
    return tf.transform_tfidf(model, news).withColumn("weight", F.round("weight", 6))


@checked(
    "tfidf_matrix_round_trip",
    f"{FULL} SELECT doc_id, term_id, round(weight::FLOAT::DOUBLE, 5) AS weight FROM cells",
    NEWS,
)
def _tfidf_matrix_round_trip(spark, sf):
    model, news = _fit(spark, sf)
    path = scratch_dir(spark, "matrix")
    tf.write_tfidf(tf.transform_tfidf(model, news), path, "doc_id")
    return spark.read.parquet(path).withColumn("weight", F.round(F.col("weight").cast("double"), 5))


@checked(
    "tfidf_model_round_trip",
    f"{FULL} SELECT term_id, term, round(idf, 6) AS idf, (SELECT n FROM n) AS n_docs, 3::BIGINT AS min_df, 0.9::DOUBLE AS max_df FROM vocab",
    NEWS,
)
def _tfidf_model_round_trip(spark, sf):
    model, _ = _fit(spark, sf)
    path = scratch_dir(spark, "model")
    tf.save_model(model, path)
    again = tf.load_model(spark, path)
    return again.vocabulary.select(
        "term_id",
        "term",
        F.round("idf", 6).alias("idf"),
        F.lit(again.n_docs).cast("bigint").alias("n_docs"),
        F.lit(again.config.min_df).cast("bigint").alias("min_df"),
        F.lit(again.config.max_df).cast("double").alias("max_df"),
    )


@checked(
    "tfidf_config",
    f"""{_model_sql(12_000)} SELECT '1,2' AS ngram_range, 3::BIGINT AS min_df, 0.9::DOUBLE AS max_df, 12000 AS max_features, 'l2' AS norm,
      true AS use_idf, true AS smooth_idf, false AS sublinear_tf, 'float32' AS dtype, count(*) AS n_terms FROM vocab""",
    NEWS,
)
def _tfidf_config(spark, sf):
    model, _ = _fit(spark, sf, tf.TfidfConfig(max_features=12_000))
    path = scratch_dir(spark, "config")
    tf.write_config(model, path)
    config = spark.read.schema(
        "ngram_range array<int>, min_df bigint, max_df double, max_features int, norm string, "
        "use_idf boolean, smooth_idf boolean, sublinear_tf boolean, dtype string"
    ).json(path)
    n_terms = model.vocabulary.agg(F.count(F.lit(1))).scalar()
    return config.withColumn("ngram_range", F.array_join("ngram_range", ",")).withColumn("n_terms", n_terms)


@checked("idf_table", f"{FULL} SELECT term, round(idf, 6) AS idf FROM vocab", NEWS)
def _idf_table(spark, sf):
    model, _ = _fit(spark, sf)
    return tf.idf_table(model).withColumn("idf", F.round("idf", 6))


@checked(
    "common_terms",
    f"{FULL} SELECT term, round(idf, 6) AS idf FROM vocab ORDER BY vocab.idf, term LIMIT 10",
    NEWS,
)
def _common_terms(spark, sf):
    model, _ = _fit(spark, sf)
    return tf.common_terms(model).withColumn("idf", F.round("idf", 6))


@checked(
    "rare_terms",
    f"{FULL} SELECT term, round(idf, 6) AS idf FROM vocab ORDER BY vocab.idf DESC, term LIMIT 10",
    NEWS,
)
def _rare_terms(spark, sf):
    model, _ = _fit(spark, sf)
    return tf.rare_terms(model).withColumn("idf", F.round("idf", 6))


SHAPE_SQL = """(SELECT n FROM n) AS n_docs, (SELECT count(*) FROM vocab) AS n_terms,
  round((SELECT count(*) FROM cells) / ((SELECT n FROM n)::DOUBLE * (SELECT count(*) FROM vocab)), 9) AS density"""


@checked("embedding_shape", f"{FULL} SELECT {SHAPE_SQL}, (SELECT count(*) FROM cells) AS nnz", NEWS)
def _embedding_shape(spark, sf):
    model, news = _fit(spark, sf)
    shape = tf.embedding_shape(model, tf.transform_tfidf(model, news))
    return shape.withColumn("density", F.round("density", 9))


@checked(
    "embedding_summary",
    f"""{FULL}, first_doc AS (SELECT min(doc_id) AS doc_id FROM cells)
    SELECT {SHAPE_SQL},
      (SELECT string_agg(term, ', ' ORDER BY idf, term) FROM (SELECT * FROM vocab ORDER BY idf, term LIMIT 10) t) AS common_terms,
      (SELECT string_agg(term, ', ' ORDER BY idf DESC, term) FROM (SELECT * FROM vocab ORDER BY idf DESC, term LIMIT 10) t) AS rare_terms,
      (SELECT string_agg(term, ', ' ORDER BY weight DESC, term) FROM (SELECT * FROM cells WHERE doc_id = (SELECT doc_id FROM first_doc) ORDER BY weight DESC, term LIMIT 10) t) AS example_terms""",
    NEWS,
)
def _embedding_summary(spark, sf):
    model, news = _fit(spark, sf)
    weights = stored(tf.transform_tfidf(model, news), "weights")
    first = weights.agg(F.min("doc_id")).first()[0]
    return tf.embedding_summary(model, weights, first).withColumn("density", F.round("density", 9))


@checked(
    "top_terms",
    f"""{FULL} SELECT doc_id, term, round(weight, 6) AS weight FROM (
      SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, term) AS r FROM cells) t WHERE r <= 10""",
    NEWS,
)
def _top_terms(spark, sf):
    model, news = _fit(spark, sf)
    top = tf.top_terms(tf.transform_tfidf(model, news), "doc_id", 10)
    return top.select("doc_id", "term", F.round("weight", 6).alias("weight"))


@checked(
    "cosine_pairs",
    f"""{FULL}, pairs AS (SELECT doc_id AS a, doc_id + 1 AS b FROM news)
    SELECT p.a, p.b, round(coalesce(d.cosine, 0), 6) AS cosine FROM pairs p LEFT JOIN (
      SELECT x.doc_id AS a, y.doc_id AS b, sum(x.weight * y.weight) AS cosine
      FROM cells x JOIN cells y ON y.term_id = x.term_id AND y.doc_id = x.doc_id + 1 GROUP BY x.doc_id, y.doc_id) d ON d.a = p.a AND d.b = p.b""",
    NEWS,
)
def _cosine_pairs(spark, sf):
    model, news = _fit(spark, sf)
    pairs = news.select(F.col("doc_id").alias("a"), (F.col("doc_id") + 1).alias("b"))
    weights = stored(tf.transform_tfidf(model, news), "weights")
    return tf.cosine_pairs(weights, pairs, "doc_id").withColumn("cosine", F.round("cosine", 6))


# ---------------------------------------------------------------- topics

K, ROUNDS, SEED = 2, 3, 42


def _unit_sql(key: str, j: int) -> str:
    return f"((('0x' || substr(md5({key}::VARCHAR || '#{j}#{SEED}'), 1, 8))::BIGINT + 0.5) / 4294967296.0::DOUBLE)"


def _nmf_sql(k: int, rounds: int) -> str:
    """The updates written out, one set of clauses per round."""
    js = range(k)

    def sums(letter: str, table: str) -> str:
        return f"SELECT {', '.join(f'sum({letter}{i} * {letter}{j}) AS g{i}{j}' for i in js for j in js)} FROM {table}"

    def mixed(letter: str, j: int, alias: str) -> str:
        return " + ".join(f"{alias}.{letter}{i} * g.g{i}{j}" for i in js)

    parts = [
        f"""{LEMMA_SQL},
  x AS MATERIALIZED (SELECT doc_id, lemma AS term, count(*)::DOUBLE AS cnt FROM lemmas WHERE lemma NOT IN (SELECT word FROM stopwords) GROUP BY doc_id, lemma),
  scale AS (SELECT sqrt(sum(cnt) / (count(DISTINCT doc_id) * count(DISTINCT term)) / {k}) AS s FROM x)""",
        f"h_0 AS MATERIALIZED (SELECT term, {', '.join(f'{_unit_sql("term", j)} * (SELECT s FROM scale) AS h{j}' for j in js)} FROM (SELECT DISTINCT term FROM x) t)",
        f"w_0 AS MATERIALIZED (SELECT doc_id, {', '.join(f'{_unit_sql("doc_id", j)} * (SELECT s FROM scale) AS w{j}' for j in js)} FROM (SELECT DISTINCT doc_id FROM x) t)",
    ]
    for r in range(rounds):
        parts += [
            f"g_{r} AS MATERIALIZED ({sums('h', f'h_{r}')})",
            f"a_{r} AS (SELECT x.doc_id, {', '.join(f'sum(x.cnt * h.h{j}) AS n{j}' for j in js)} FROM x JOIN h_{r} h ON h.term = x.term GROUP BY x.doc_id)",
            f"w_{r + 1} AS MATERIALIZED (SELECT w.doc_id, {', '.join(f'w.w{j} * a.n{j} / ({mixed("w", j, "w")} + 1e-12) AS w{j}' for j in js)} FROM w_{r} w JOIN a_{r} a ON a.doc_id = w.doc_id, g_{r} g)",
            f"f_{r} AS MATERIALIZED ({sums('w', f'w_{r + 1}')})",
            f"b_{r} AS (SELECT x.term, {', '.join(f'sum(x.cnt * w.w{j}) AS n{j}' for j in js)} FROM x JOIN w_{r + 1} w ON w.doc_id = x.doc_id GROUP BY x.term)",
            f"h_{r + 1} AS MATERIALIZED (SELECT h.term, {', '.join(f'h.h{j} * b.n{j} / ({mixed("h", j, "h")} + 1e-12) AS h{j}' for j in js)} FROM h_{r} h JOIN b_{r} b ON b.term = h.term, f_{r} g)",
        ]
    # Documents under the final topics, from equal starting weights.
    parts += [
        f"gt AS MATERIALIZED ({sums('h', f'h_{rounds}')})",
        f"at_ AS MATERIALIZED (SELECT x.doc_id, {', '.join(f'sum(x.cnt * h.h{j}) AS n{j}' for j in js)} FROM x JOIN h_{rounds} h ON h.term = x.term GROUP BY x.doc_id)",
        f"t_0 AS (SELECT doc_id, {', '.join(f'1.0::DOUBLE AS w{j}' for j in js)} FROM at_)",
    ]
    for r in range(rounds):
        parts.append(
            f"t_{r + 1} AS MATERIALIZED (SELECT w.doc_id, {', '.join(f'w.w{j} * a.n{j} / ({mixed("w", j, "w")} + 1e-12) AS w{j}' for j in js)} FROM t_{r} w JOIN at_ a ON a.doc_id = w.doc_id, gt g)"
        )
    return ",\n".join(parts)


NMF_VIEWS = ("news", "lexicon", "stopwords")
NMF_SQL = _nmf_sql(K, ROUNDS)


def _loadings_sql(k: int) -> str:
    return " UNION ALL ".join(f"SELECT doc_id, {j} AS topic, w{j} AS loading FROM t_{ROUNDS}" for j in range(k))


def _assign_sql(k: int) -> str:
    return f"assigned AS (SELECT doc_id, topic FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY loading DESC, topic) AS r FROM ({_loadings_sql(k)}) l) t WHERE r = 1)"


def _names_sql(k: int) -> str:
    loads = " UNION ALL ".join(f"SELECT term, {j} AS topic, h{j} AS load FROM h_{ROUNDS}" for j in range(k))
    return f"names AS (SELECT topic, string_agg(term, '_' ORDER BY load DESC, term) AS name FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY load DESC, term) AS r FROM ({loads}) l) t WHERE r <= 4 GROUP BY topic)"


LOADINGS_SQL, ASSIGN_SQL, NAMES_SQL = _loadings_sql(K), _assign_sql(K), _names_sql(K)


def _bag(spark, sf):
    bag = tk.bag_of_words(
        view(spark, sf, "news"), "doc_id", "article_text", view(spark, sf, "lexicon"), view(spark, sf, "stopwords")
    )
    return stored(bag, "bag")


def _topics(spark, sf):
    bag = _bag(spark, sf)
    return tp.fit_nmf(bag, "doc_id", K, ROUNDS, SEED, tol=-1.0), bag


@checked(
    "nmf_topic_terms",
    f"{NMF_SQL} SELECT term, {', '.join(f'round(h{j}, 6) AS h{j}' for j in range(K))} FROM h_{ROUNDS}",
    NMF_VIEWS,
)
def _nmf_topic_terms(spark, sf):
    model, _ = _topics(spark, sf)
    return model.topics.select("term", *[F.round(f"h{j}", 6).alias(f"h{j}") for j in range(K)])


@checked(
    "nmf_loadings",
    f"{NMF_SQL} SELECT doc_id, topic, round(loading, 6) AS loading FROM ({LOADINGS_SQL}) l",
    NMF_VIEWS,
)
def _nmf_loadings(spark, sf):
    model, bag = _topics(spark, sf)
    return tp.transform_nmf(model, bag, ROUNDS, tol=-1.0).withColumn("loading", F.round("loading", 6))


@checked("assign_topic", f"{NMF_SQL}, {ASSIGN_SQL} SELECT doc_id, topic FROM assigned", NMF_VIEWS)
def _assign_topic(spark, sf):
    model, bag = _topics(spark, sf)
    return tp.assign_topic(tp.transform_nmf(model, bag, ROUNDS, tol=-1.0), "doc_id")


@checked("name_topics", f"{NMF_SQL}, {NAMES_SQL} SELECT topic, name FROM names", NMF_VIEWS)
def _name_topics(spark, sf):
    model, _ = _topics(spark, sf)
    return tp.name_topics(model)


def _label_sql(k: int) -> str:
    return f"""{_nmf_sql(k, ROUNDS)}, {_assign_sql(k)}, {_names_sql(k)},
  labelled AS (SELECT n.doc_id, CASE WHEN n.article_text IS NOT NULL THEN coalesce(m.name, (SELECT name FROM names WHERE topic = 0)) END AS topic
    FROM news n LEFT JOIN assigned a ON a.doc_id = n.doc_id LEFT JOIN names m ON m.topic = a.topic)"""


LABEL_SQL = _label_sql(K)
SHARE_SQL = """SELECT topic, n, round(100.0::DOUBLE * n / sum(n) OVER (), 1) AS percent FROM (
      SELECT topic, count(*) AS n FROM labelled WHERE topic IS NOT NULL GROUP BY topic) t"""


def _labelled(spark, sf, k=K):
    bag = _bag(spark, sf)
    model = tp.fit_nmf(bag, "doc_id", k, ROUNDS, SEED, tol=-1.0)
    news = view(spark, sf, "news").select("doc_id", "article_text")
    return tp.label_topics(news, "article_text", model, tp.transform_nmf(model, bag, ROUNDS, tol=-1.0)).drop("article_text")


@checked("label_topics", f"{LABEL_SQL} SELECT doc_id, topic FROM labelled", NMF_VIEWS)
def _label_topics(spark, sf):
    return _labelled(spark, sf)


@checked("topic_share", f"{LABEL_SQL} {SHARE_SQL}", NMF_VIEWS)
def _topic_share(spark, sf):
    return reports.share(_labelled(spark, sf), "topic")


@checked("five_topic_share", f"{_label_sql(5)} {SHARE_SQL}", NMF_VIEWS)
def _five_topic_share(spark, sf):
    return reports.share(_labelled(spark, sf, 5), "topic")


@checked("fitted_topic_share")
def _fitted_topic_share(spark, sf):
    """Five topics fitted until they settle; too many rounds to write out in SQL."""
    model = nmf.factor_nmf(_bag(spark, sf), "doc_id", 5, seed=SEED)
    news = view(spark, sf, "news").select("doc_id", "article_text")
    return reports.share(tp.label_topics(news, "article_text", model, nmf.document_topics(model)), "topic")


# One topic has one optimum: the leading pair of singular vectors, to which powers of X'X lead.
POWERS = 240
ONE_TOPIC_SQL = f"""{_nmf_sql(1, 0).split("""  scale AS""")[0]}
  powers AS (SELECT 0 AS r, term, 1.0::DOUBLE AS h FROM (SELECT DISTINCT term FROM x) t UNION ALL
    SELECT r + 1, term, h / sqrt(sum(h * h) OVER ()) FROM (SELECT u.r, x.term, sum(x.cnt * u.w) AS h FROM x JOIN (
      SELECT p.r, x.doc_id, sum(x.cnt * p.h) AS w FROM x JOIN powers p ON p.term = x.term WHERE p.r < {POWERS} GROUP BY p.r, x.doc_id) u ON u.doc_id = x.doc_id GROUP BY u.r, x.term) n),
  settled AS MATERIALIZED (SELECT term, h FROM powers WHERE r = {POWERS}),
  last AS MATERIALIZED (SELECT x.doc_id, sum(x.cnt * v.h) AS w FROM x JOIN settled v ON v.term = x.term GROUP BY x.doc_id)"""


@checked("one_topic_terms", f"{ONE_TOPIC_SQL} SELECT term, round(h, 5) AS share FROM settled", NMF_VIEWS)
def _one_topic_terms(spark, sf):
    model = nmf.factor_nmf(_bag(spark, sf), "doc_id", 1, seed=SEED, tol=1e-8)
    norm = model.topics.agg(F.sqrt(F.sum(F.col("h0") * F.col("h0")))).first()[0]
    return model.topics.select("term", F.round(F.col("h0") / norm, 5).alias("share"))


@checked(
    "fitted_topic_optimum",
    f"""{ONE_TOPIC_SQL} SELECT count(*) AS n_cells, count(DISTINCT doc_id) AS n_docs, count(DISTINCT term) AS n_terms, sum(cnt * cnt) AS squares,
      round(sum(cnt * cnt) - (SELECT sum(w * w) FROM last), 2) AS one_topic_loss,
      true AS five_are_better, true AS never_rises, true AS topics_settled, true AS weights_optimal, true AS non_negative FROM x""",
    NMF_VIEWS,
)
def _fitted_topic_optimum(spark, sf):
    """The fit of five topics against the conditions of an optimum, recomputed from its tables by joins and sums."""
    bag = _bag(spark, sf)
    one, five = (nmf.factor_nmf(bag, "doc_id", k, seed=SEED) for k in (1, 5))
    falls = all(b <= a * (1 + 1e-12) for a, b in zip(five.losses, five.losses[1:]))
    held = nmf.optimality(bag, five).first()
    sizes = bag.agg(F.count(F.lit(1)).alias("n_cells"), F.count_distinct("doc_id").alias("n_docs"), F.count_distinct("term").alias("n_terms"))
    return sizes.select(
        "n_cells", "n_docs", "n_terms", F.lit(float(held["squares"])).alias("squares"), F.lit(round(one.losses[-1], 2)).alias("one_topic_loss"),
        F.lit(held["loss"] < one.losses[-1]).alias("five_are_better"), F.lit(falls).alias("never_rises"),
        F.lit(held["steepest_topics"] < 1e-3).alias("topics_settled"), F.lit(held["steepest_weights"] < 1e-8).alias("weights_optimal"),
        F.lit(held["least"] >= 0).alias("non_negative"),
    )
