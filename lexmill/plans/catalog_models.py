"""Registered queries: normal forms, fitted models, experiments, scoring."""

from __future__ import annotations

import uuid

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from lexmill.functions.tokenizers import tokenize_contractions
from lexmill.functions.wordlists import CLASSES
from lexmill.operators import (bow as B, corpus as D, dimensions as X, embeddings as E,
                               experiments as R, logistic as LR, normalizing as N, scoring as G,
                               tfidf as TF)
from lexmill.plans.catalog import (MAX_TERMS, nb_alpha_sweep, query, split_documents,
                                   vectors as embedding_vectors)
from lexmill.plans.layout import spread
from lexmill.plans.tables import clean_documents, prepared_documents, table
from lexmill.session import materialize, shared_folder
from lexmill.sources import lake

# Word vectors are trained in this many parts at least, on any cluster.
WORD_VECTOR_PARTITIONS = 8


# --- normal forms --------------------------------------------------------------

def words(spark: SparkSession, base: str) -> DataFrame:
    return N.distinct_words(prepared_documents(spark, base))


@query
def normalize_via_vocab(spark, base):
    docs = prepared_documents(spark, base)
    rows = N.normalize_via_vocab(docs, N.lemma_vocab(words(spark, base)))
    return rows.select("doc_id", F.array_join("tokens_normalized", " ").alias("tokens"))


@query
def stem_vocab_porter(spark, base):
    return N.stem_vocab(words(spark, base), "porter")


@query
def stem_vocab_snowball(spark, base):
    return N.stem_vocab(words(spark, base), "snowball")


@query
def lemma_vocab(spark, base):
    return N.lemma_vocab(words(spark, base))


@query
def lemma_vocab_dictionary(spark, base):
    """Dictionary built from the benchmark texts: word → its lowercase form
    without a final s."""
    items = table(spark, base, "benchmark").select(
        F.explode(tokenize_contractions(F.lower("text"))).alias("word")).distinct()
    dictionary = items.select("word", F.regexp_replace("word", "s$", "").alias("lemma")).filter("lemma <> ''")
    return N.lemma_vocab(words(spark, base), dictionary)


@query
def vocab_reduction_lemma(spark, base):
    return N.vocab_reduction(prepared_documents(spark, base), ["lemma"])


@query
def vocab_reduction(spark, base):
    return N.vocab_reduction(prepared_documents(spark, base))


@query
def over_stemming_lemma(spark, base):
    return N.over_stemming(words(spark, base), ["lemma"])


@query
def over_stemming(spark, base):
    return N.over_stemming(words(spark, base))


@query
def preprocess(spark, base):
    docs = spread(table(spark, base, "documents").select("doc_id", "text"), "doc_id")
    rows = N.preprocess(docs)
    return rows.select("doc_id", F.array_join("tokens", " ").alias("tokens"),
                       F.array_join("removed_stopwords", " ").alias("removed"),
                       F.array_join("processing_steps", ",").alias("steps"), "token_count")


@query
def preprocess_clean_tokenize(spark, base):
    docs = spread(table(spark, base, "documents").select("doc_id", "text"), "doc_id")
    rows = N.preprocess(docs, ["clean", "tokenize"])
    return rows.select("doc_id", F.array_join("tokens", " ").alias("tokens"),
                       F.array_join("processing_steps", ",").alias("steps"), "token_count")


# --- vectors for Spark ML ------------------------------------------------------

@query
def count_vectors(spark, base):
    """Vectors of every term, spread out to (doc_id, term, tf)."""
    docs = prepared_documents(spark, base).select("doc_id", "tokens")
    vocab, rows = B.count_vectors(docs, max_features=None)
    cells = LR.vector_cells(rows.select("doc_id", "features"))
    return cells.join(vocab.select(F.col("idx").alias("i"), "term"), "i").select(
        "doc_id", "term", F.col("value").cast("long").alias("tf"))


def split_weights(spark: SparkSession, base: str, size: int = MAX_TERMS):
    carry = ("label", "is_test")
    counts = B.counted_documents(split_documents(spark, base), carry=carry, name="split_counts")
    tf = B.unfolded(counts, keep_empty=True)
    n = B.document_count(B.document_rows(counts))
    fitted = materialize(TF.fit_tfidf(tf.filter(F.col("term").isNotNull()), n, max_features=size), "fitted")
    return fitted, TF.transform_tfidf(tf, fitted, carry=carry, max_features=size, keep_unknown=True)


def split_vectors(spark: SparkSession, base: str, size: int = MAX_TERMS):
    fitted, w = split_weights(spark, base, size)
    return fitted, LR.sparse_vectors(w, size)


def word_vectors(spark: SparkSession, base: str) -> DataFrame:
    docs = prepared_documents(spark, base).select("doc_id", "tokens")
    vectors = E.train_skipgram(docs, partitions=WORD_VECTOR_PARTITIONS)
    return vectors.select("word", F.col("vector").cast("array<double>").alias("vector"))


@query
def train_skipgram(spark, base):
    return word_vectors(spark, base).select("word", F.array_join(F.transform("vector", lambda x: F.format_string("%.6f", x)), " ").alias("vector"))


def embedding_doc_vectors(spark: SparkSession, base: str) -> DataFrame:
    """Mean vector of a document's words, with embedding i as the vector of
    vocabulary word i."""
    docs = prepared_documents(spark, base)
    vocab = B.vocabulary(B.term_counts(docs))
    known = vocab.join(embedding_vectors(spark, base).withColumnRenamed("word", "vec_id"),
                       F.col("idx") == F.col("vec_id")).select(F.col("term").alias("word"), "vector")
    return E.doc_vectors(docs, known, 64)


@query
def doc_vectors(spark, base):
    rows = embedding_doc_vectors(spark, base)
    return rows.select("doc_id", *[F.get("doc_vector", i).alias(f"v{i}") for i in range(64)])


@query
def concat_features(spark, base):
    """TF-IDF weights and mean vectors side by side, as (doc_id, i, value)."""
    _, vectors = split_vectors(spark, base)
    dense = embedding_doc_vectors(spark, base)
    both = E.concat_features(E.beside_doc_vectors(vectors, dense), ["terms", "words"])
    return LR.vector_cells(both.select("doc_id", "features"))


# --- logistic regression -------------------------------------------------------

def scored_by_lr(spark: SparkSession, base: str):
    fitted, vectors = split_vectors(spark, base)
    return fitted, *fit_and_score(vectors)


def fit_and_score(vectors: DataFrame):
    model = LR.lr_fit(vectors.filter(~F.col("is_test")))
    return model, LR.lr_score(model, vectors.filter("is_test"))


@query
def lr_variants(spark, base):
    return LR.lr_variants(split_vectors(spark, base)[1])


@query
def lr_fit(spark, base):
    fitted, model, _ = scored_by_lr(spark, base)
    return LR.coefficients(model, fitted)


def lr_gradient_entries(spark: SparkSession, base: str) -> DataFrame:
    """Penalised gradient of the mean training loss at the fitted coefficients,
    one row a term with a column per class."""
    vectors = split_vectors(spark, base)[1]
    train = materialize(vectors.filter(~F.col("is_test")), "train", schema=vectors.schema)
    model, n = LR.lr_fit(train), train.count()
    rest = LR.lr_score(model, train).select("doc_id", *[
        (F.col(f"p_{c}") - (F.col("label") == c).cast("double")).alias(f"r_{c}") for c in CLASSES])
    sums = LR.vector_cells(train).join(rest, "doc_id").groupBy("i").agg(
        *[(F.sum(F.col("value") * F.col(f"r_{c}")) / n).alias(f"g_{c}") for c in CLASSES])
    matrix = model.coefficientMatrix.toArray()
    coefs = spark.createDataFrame([(i, *map(float, matrix[:, i])) for i in range(matrix.shape[1])],
                                  "i int, " + ", ".join(f"`b_{c}` double" for c in CLASSES))
    return coefs.join(sums, "i", "left").select("i", *[
        (F.coalesce(F.col(f"g_{c}"), F.lit(0.0)) + F.col(f"b_{c}") / n).alias(f"g_{c}") for c in CLASSES])


@query
def lr_gradient(spark, base):
    """Whether the fit is a minimum: per class, the largest gradient entry is
    below a thousandth."""
    rows = lr_gradient_entries(spark, base).agg(*[F.max(F.abs(f"g_{c}")).alias(c) for c in CLASSES])
    return rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("class"), (F.col(c) < 1e-3).alias("minimal"))
                                           for c in CLASSES])).alias("x")).select("x.class", "x.minimal")


@query
def lr_top_features(spark, base):
    fitted, model, _ = scored_by_lr(spark, base)
    return LR.lr_top_features(LR.coefficients(model, fitted))


@query
def lr_score(spark, base):
    _, _, scored = scored_by_lr(spark, base)
    return scored.select("doc_id", "label", "prediction", "confidence", *[f"p_{c}" for c in CLASSES])


@query
def lr_explain_scores(spark, base):
    fitted, w = split_weights(spark, base)
    model, scored = fit_and_score(LR.sparse_vectors(w, MAX_TERMS))
    return LR.explain_scores(w.filter("is_test"), LR.coefficients(model, fitted), scored)


@query
def feature_set_comparison(spark, base):
    _, vectors = split_vectors(spark, base)
    dense = E.doc_vectors(prepared_documents(spark, base), word_vectors(spark, base), 200)
    return LR.feature_set_comparison(vectors, dense)


# --- projection, polynomials, scaling ------------------------------------------

def points(spark: SparkSession, base: str) -> DataFrame:
    return X.pca2(split_vectors(spark, base)[1])[0]


@query
def pca2(spark, base):
    rows, ratios = X.pca2(split_vectors(spark, base)[1])
    return rows.select("doc_id", "pc1", "pc2", *[F.lit(r).alias(f"ratio{i + 1}") for i, r in enumerate(ratios)])


@query
def pca2_moments(spark, base):
    """What makes the projection a principal one, to three digits: centred,
    uncorrelated, the shares of the variance in order."""
    rows, ratios = X.pca2(split_vectors(spark, base)[1])
    return rows.agg(F.round(F.avg("pc1"), 3).alias("mean1"), F.round(F.avg("pc2"), 3).alias("mean2"),
                    F.round(F.corr("pc1", "pc2"), 3).alias("correlation"),
                    (F.round(F.var_pop("pc1") / F.var_pop("pc2") / F.lit(ratios[0] / ratios[1]), 3)).alias("shares"))


def dimensions(spark: SparkSession, base: str, names: list[str]) -> DataFrame:
    """The first dimensions of every embedding as columns."""
    return table(spark, base, "embeddings").select(
        "vec_id", *[F.get("embedding", i).cast("double").alias(n) for i, n in enumerate(names)])


@query
def poly_expand(spark, base):
    """Products of two columns, as the library's users have them, up to degree 3."""
    return X.poly_expand(dimensions(spark, base, ["a", "b"]), ["a", "b"], 3)


@query
def poly_feature_count(spark, base):
    sizes = B.vocabulary(B.term_counts(prepared_documents(spark, base))).agg(F.count(F.lit(1)).alias("n"))
    return sizes.select("n", *[X.poly_feature_count(F.col("n"), d).alias(f"degree_{d}") for d in (1, 2, 3)])


@query
def poly_lr_sweep(spark, base):
    return X.poly_lr_sweep(points(spark, base))


@query
def decision_grid(spark, base):
    return X.decision_grid(points(spark, base))


@query
def minmax_scale(spark, base):
    names = [f"v{i}" for i in range(64)]
    return X.minmax_scale(dimensions(spark, base, names), names)


# --- experiments and promotion -------------------------------------------------

def split_texts(spark: SparkSession, base: str) -> DataFrame:
    docs = prepared_documents(spark, base).select("doc_id", "label", "text_clean")
    return D.stratified_split(docs, 0.2)


@query
def ablation(spark, base):
    """Logistic regression on all six configurations."""
    return R.ablation(split_texts(spark, base))


@query
def ablation_naive_bayes(spark, base):
    """Naive Bayes on all six configurations."""
    return R.ablation(split_texts(spark, base), model="bayes")


def versions(spark: SparkSession, base: str) -> DataFrame:
    """The strengths of the Naive Bayes sweep as successive model versions,
    scored by weighted F1, precision and recall."""
    sweep = nb_alpha_sweep(spark, base)
    version = sum((F.col("alpha") >= a).cast("long") for a in (0.01, 0.1, 0.5, 1.0, 2.0, 5.0))
    return sweep.select(version.alias("version"), F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), F.round(m, 6).alias("f1"))
        for m in ("f1", "precision", "recall")])).alias("m")).select("m.model", "version", "m.f1")


@query
def promote(spark, base):
    return R.promote(versions(spark, base))


@query
def production_version(spark, base):
    live = R.production_version(R.promote(versions(spark, base)))
    history = F.array_join(F.transform("history", lambda h: F.concat(h["version"].cast("string"), F.lit(":"), h["stage"])), " ")
    return live.select("model", "version", "f1", "n_versions", history.alias("history"))


@query
def performance_table(spark, base):
    staged = materialize(R.promote(versions(spark, base)), "staged")
    metrics = staged.select("model", F.concat(F.lit("f1_v"), "version").alias("metric"), F.col("f1").alias("value"))
    rows = R.performance_table(staged, metrics)
    named = F.transform(F.array_sort(F.map_entries("metrics")), lambda m: F.concat(
        m["key"], F.lit("="), F.format_string("%.6f", m["value"])))
    return rows.select("model", "version", "f1", "n_versions", F.array_join(named, " ").alias("metrics"))


# --- scoring and request accounting --------------------------------------------

def conversations(spark: SparkSession, base: str) -> DataFrame:
    turns = spread(table(spark, base, "conversations"), "conv_id")
    return turns.select(F.concat_ws("-", "conv_id", "turn").alias("doc_id"), "text")


def scoring_model(spark: SparkSession, base: str) -> G.ScoringModel:
    return G.fit_scoring_model(clean_documents(spark, base), MAX_TERMS)


@query
def score_texts(spark, base):
    scored = G.score_texts(conversations(spark, base), scoring_model(spark, base))
    names = F.transform("top_features", lambda m: F.get(F.map_keys(m), 0))
    return scored.select(
        "doc_id", "prediction", "confidence",
        *[F.element_at("class_probabilities", c).alias(f"p_{c}") for c in CLASSES],
        F.array_join(names, " ").alias("top_features"))


@query
def score_texts_logistic(spark, base):
    """Scores by a logistic model that was saved and loaded."""
    path = f"{shared_folder(spark)}/logistic_{uuid.uuid4().hex}"
    fitted, model, _ = scored_by_lr(spark, base)
    lake.save_model_tables(path, "v1", {}, {"lr": model})
    loaded = lake.load_model(path, "v1", "lr", LogisticRegressionModel)
    scored = G.score_texts(conversations(spark, base), G.logistic_scoring_model(loaded, fitted, MAX_TERMS))
    return scored.select("doc_id", "prediction", "confidence",
                         *[F.element_at("class_probabilities", c).alias(f"p_{c}") for c in CLASSES])


@query
def explain_scores(spark, base):
    scored = G.score_texts(conversations(spark, base), scoring_model(spark, base))
    rows = scored.select("doc_id", F.posexplode("top_features").alias("pos", "m"))
    return rows.select("doc_id", (F.col("pos") + 1).alias("rank"), F.explode("m").alias("term", "contribution"))


@query
def score_batches(spark, base):
    turns = spread(table(spark, base, "conversations"), "conv_id")
    return G.score_batches(turns, scoring_model(spark, base), "conv_id", "turn")


def _quota(name: str, limit: int) -> None:
    def build(spark, base):
        return G.quota_audit(table(spark, base, "events"), limit)
    build.__name__ = name
    query(build)


_quota("quota_audit_single", G.SINGLE_QUOTA)
_quota("quota_audit_batch", G.BATCH_QUOTA)


@query
def quota_audit_type(spark, base):
    """The batch quota per event type."""
    return G.quota_audit(table(spark, base, "events"), G.BATCH_QUOTA, "event_type")
