"""Registered queries, one per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from lexmill.functions import cleaning as C, tokenizers as K
from lexmill.functions.wordlists import CLASSES, CODE_SWITCH_WORDS, stopwords
from lexmill.operators import (bayes as NB, bow as B, cleaning as OC, corpus as D, embeddings as E,
                               metrics as M, ngrams as L, retrieval as R, tfidf as TF,
                               tokenizing as T)
from lexmill.plans.layout import settled, spread
from lexmill.plans.tables import (clean_documents, corpus, prepared_documents, query_texts, table,
                                  tidy, token_documents)
from lexmill.session import materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under its function name; results are tidied."""
    QUERIES[build.__name__] = lambda spark, base: tidy(build(spark, base))
    return build


def documents(spark: SparkSession, base: str) -> DataFrame:
    return spread(table(spark, base, "documents"), "doc_id")


# --- labels, filters, validation -------------------------------------------

RATINGS = ("true", "mostly-true", "half-true", "false", "pants-fire", "barely-true", "unrated")


def rated(spark: SparkSession, base: str) -> DataFrame:
    """Documents with a rating read off the number in their source name."""
    number = F.regexp_extract("source", "[0-9]+", 0).cast("int") % 8
    rating = F.get(F.array(*[F.lit(r) for r in RATINGS]), number)
    return table(spark, base, "documents").select("doc_id", "text", rating.alias("rating"))


@query
def map_labels(spark, base):
    return D.map_labels(rated(spark, base), "rating").select("doc_id", "rating", "mapped_label")


@query
def drop_missing(spark, base):
    kept = D.drop_missing(D.map_labels(rated(spark, base), "rating"), ["mapped_label", "text"])
    return kept.select("doc_id", "mapped_label")


@query
def keep_flagged(spark, base):
    flagged = table(spark, base, "labels").select("doc_id", F.col("toxic").alias("is_sarcastic"))
    return D.keep_flagged(flagged).select("doc_id", "label")


@query
def conform(spark, base):
    rows = D.conform(D.map_labels(rated(spark, base), "rating"), "statements", "text",
                     "mapped_label", "rating")
    return rows.select(F.md5("text").alias("text_md5"), "label", "source", "original_label")


@query
def drop_short_clean(spark, base):
    docs = documents(spark, base).withColumn("text_clean", C.clean_text(F.col("text")))
    return D.drop_short_clean(docs).select("doc_id", F.length("text_clean").alias("n_clean"))


@query
def keep_classes(spark, base):
    return D.keep_classes(corpus(spark, base).drop("text"), ["Real", "Fake"]).select("doc_id", "label")


@query
def encode_labels(spark, base):
    return D.encode_labels(corpus(spark, base).select("doc_id", "label")).select(
        "doc_id", "label", "label_idx")


@query
def decode_labels(spark, base):
    rows = corpus(spark, base).select("doc_id", "label")
    coded = D.encode_labels(rows).select("doc_id", "label_idx")
    return D.decode_labels(coded, D.class_array(rows)).select("doc_id", "label_idx", "label")


@query
def validate_texts(spark, base):
    return D.validate_texts(table(spark, base, "documents")).select("doc_id", "reason", "accepted")


@query
def validate_batches(spark, base):
    return D.validate_batches(table(spark, base, "conversations"), "conv_id", "turn")


@query
def preview(spark, base):
    return table(spark, base, "documents").select(
        "doc_id", *[D.preview(F.col("text"), n).alias(f"first_{n}") for n in (60, 80, 100, 500)])


# --- set operations, sampling, duplicates, balance, splits ------------------

@query
def union_sources(spark, base):
    docs = table(spark, base, "documents").select("text", F.col("source"))
    bench = table(spark, base, "benchmark").select("text", F.lit("benchmark").alias("source"))
    turns = table(spark, base, "conversations").select("text", F.col("role").alias("source"))
    return D.union_sources(docs, bench, turns).select("source", F.md5("text").alias("text_md5"))


@query
def sample_n(spark, base):
    return D.sample_n(table(spark, base, "documents").select("doc_id", "source"), 200)


@query
def cap_per_group(spark, base):
    docs = table(spark, base, "documents").select("doc_id", "source", "lang")
    return D.cap_per_group(docs, ["source", "lang"], 20)


@query
def cap_per_class(spark, base):
    caps = {("Real",): 150, ("Fake",): 30}
    return D.cap_per_group(corpus(spark, base).select("doc_id", "label"), ["label"], caps)


@query
def dedup_exact(spark, base):
    docs = table(spark, base, "documents").select("doc_id", "text", "source")
    return D.dedup_exact(docs, "source").select("doc_id", "source")


@query
def duplicate_rate(spark, base):
    return D.duplicate_rate(table(spark, base, "documents").select("text"))


@query
def class_distribution(spark, base):
    return D.class_distribution(corpus(spark, base).select("label"))


@query
def source_distribution(spark, base):
    return D.class_distribution(table(spark, base, "documents").select("source"), "source")


@query
def balance_undersample(spark, base):
    return D.balance(corpus(spark, base).select("doc_id", "label"), "undersample")


@query
def balance_class_weighted(spark, base):
    return D.balance(corpus(spark, base).select("doc_id", "label"))


@query
def stratified_split(spark, base):
    return D.stratified_split(corpus(spark, base).select("doc_id", "label"), 0.2)


@query
def stratified_split_count(spark, base):
    return D.stratified_split(corpus(spark, base).select("doc_id", "label"), 100)


# --- cleaning ----------------------------------------------------------------

def _cleaned(name: str, step, table_name: str = "documents", key: str = "doc_id",
             text: str = "text") -> None:
    def build(spark, base):
        rows = spread(table(spark, base, table_name).select(key, text), key)
        return rows.select(key, step(F.col(text)).alias("result"))
    build.__name__ = name
    query(build)


_cleaned("strip_html", C.strip_html, "pages", "page_id", "html")
_cleaned("strip_urls", C.strip_urls, "pages", "page_id", "html")
_cleaned("strip_emails", C.strip_emails)
_cleaned("strip_handles", C.strip_handles)
_cleaned("strip_emoji", C.strip_emoji)
_cleaned("squeeze_punct", C.squeeze_punct)
_cleaned("mask_numbers", C.mask_numbers)
_cleaned("strip_specials", C.strip_specials)
_cleaned("fold_case", C.fold_case)
_cleaned("squeeze_space", C.squeeze_space)
_cleaned("clean_text", C.clean_text)
_cleaned("clean_text_aggressive", lambda t: C.clean_text(t, aggressive=True))
_cleaned("clean_pages", C.clean_text, "pages", "page_id", "html")


@query
def code_switch_ratio(spark, base):
    share = K.marker_share(K.tokenize_vectorizer(F.col("text")), CODE_SWITCH_WORDS)
    return documents(spark, base).select("doc_id", share.alias("share"))


@query
def clean_corpus(spark, base):
    return clean_documents(spark, base).select("doc_id", "label", "text_clean")


@query
def noise_audit(spark, base):
    return OC.noise_audit(table(spark, base, "documents"))


# --- tokens and stop words ---------------------------------------------------

def _tokenized(name: str) -> None:
    def build(spark, base):
        docs = documents(spark, base).select("doc_id", C.clean_text(F.col("text")).alias("text_clean"))
        tokens = T.tokenize_corpus(docs, name)
        return tokens.select("doc_id", F.array_join("tokens", " ").alias("tokens"),
                             F.size("tokens").alias("n_tokens"))
    build.__name__ = f"tokenize_{name}"
    query(build)


for _name in ("regex", "contractions", "whitespace", "vectorizer"):
    _tokenized(_name)


def lexicon(spark: SparkSession, base: str) -> DataFrame:
    """Word list of the benchmark texts."""
    return table(spark, base, "benchmark").select(
        F.explode(K.tokenize_vectorizer(F.col("text"))).alias("word"))


def clean_rows(spark: SparkSession, base: str) -> DataFrame:
    return documents(spark, base).select("doc_id", C.clean_text(F.col("text")).alias("text_clean"))


@query
def oov_rate(spark, base):
    docs = T.tokenize_corpus(clean_rows(spark, base), "regex")
    return T.oov_rate(docs, lexicon(spark, base))


@query
def token_stats(spark, base):
    return T.token_stats(clean_rows(spark, base), lexicon(spark, base))


@query
def contraction_accuracy(spark, base):
    """Over every distinct word with an inner apostrophe in the documents."""
    words = F.explode(F.regexp_extract_all(
        F.col("text_clean"), F.lit(r"[\p{L}\p{N}_]+'[\p{L}\p{N}_]+"), F.lit(0)))
    cases = clean_rows(spark, base).select(words.alias("word")).distinct()
    return T.contraction_accuracy(cases)


@query
def preservation_rate(spark, base):
    """Whitespace words of each document that survive word splitting."""
    rate = T.preservation_rate(F.col("text_clean"), K.tokenize_whitespace(F.col("text_clean")))
    return clean_rows(spark, base).select("doc_id", rate.alias("preserved"))


@query
def tokenize_corpus(spark, base):
    docs = T.tokenize_corpus(clean_documents(spark, base), "contractions")
    return docs.select("doc_id", "label", F.array_join("tokens", " ").alias("tokens"))


@query
def stopword_list(spark, base):
    """How often each listed word occurs in the documents, per list."""
    words = spark.createDataFrame([(k, w) for k in ("standard", "custom") for w in stopwords(k)],
                                  "list string, term string")
    counts = (documents(spark, base).select(F.explode(K.tokenize_vectorizer(F.col("text"))).alias("term"))
              .groupBy("term").agg(F.count(F.lit(1)).alias("n")))
    return (words.join(counts, "term", "left")
            .select("list", "term", F.coalesce("n", F.lit(0).cast("long")).alias("n")))


@query
def remove_stopwords(spark, base):
    docs = token_documents(spark, base, "regex")
    return docs.select("doc_id", F.array_join("tokens", " ").alias("tokens"))


@query
def removal_rate(spark, base):
    return T.removal_report(token_documents(spark, base, "regex", None))


@query
def removed_words(spark, base):
    docs = token_documents(spark, base, "regex", None)
    after = K.remove_stopwords(F.col("tokens"), stopwords("custom"))
    return docs.select("doc_id", F.array_join(K.removed_words(F.col("tokens"), after), " ").alias("removed"))


@query
def negation_incidence(spark, base):
    return T.negation_incidence(token_documents(spark, base, "regex", None))


@query
def min_token_length(spark, base):
    docs = token_documents(spark, base, "regex")
    return docs.select("doc_id", F.array_join(K.min_token_length(F.col("tokens"), 3), " ").alias("tokens"))


# --- bag of words and TF-IDF -------------------------------------------------

MAX_TERMS = 10_000


@query
def top_terms_per_class(spark, base):
    tf = B.term_counts(token_documents(spark, base), carry=("label",))
    return B.top_terms_per_class(tf)


@query
def term_counts(spark, base):
    return B.term_counts(token_documents(spark, base))


@query
def vocabulary(spark, base):
    return B.vocabulary(B.term_counts(prepared_documents(spark, base)))


@query
def matrix_stats(spark, base):
    docs = prepared_documents(spark, base)
    tf = B.term_counts(docs)
    return B.matrix_stats(tf, B.vocabulary(tf), B.document_count(docs))


@query
def export_vocabulary(spark, base):
    return B.export_vocabulary(B.vocabulary(B.term_counts(prepared_documents(spark, base))))


def weights(spark: SparkSession, base: str, variant: str = "sublinear",
            carry=(), max_features: int = MAX_TERMS) -> DataFrame:
    docs = prepared_documents(spark, base)
    tf = B.term_counts(docs, carry=carry)
    return TF.tfidf(tf, B.document_count(docs), variant, max_features=max_features, carry=carry)


def _weighted(variant: str) -> None:
    def build(spark, base):
        return weights(spark, base, variant).select("doc_id", "term", "w")
    build.__name__ = f"tfidf_{variant}"
    query(build)


for _name in TF.VARIANTS:
    _weighted(_name)


@query
def discriminative_terms(spark, base):
    docs = prepared_documents(spark, base)
    rows = weights(spark, base, carry=("label",))
    return TF.discriminative_terms(rows, docs, CLASSES)


@query
def transform_tfidf(spark, base):
    """Benchmark texts weighted with the documents' fitted table."""
    docs = prepared_documents(spark, base)
    fitted = TF.fit_tfidf(B.term_counts(docs), B.document_count(docs), max_features=MAX_TERMS)
    rows = TF.transform_tfidf(B.term_counts(query_texts(spark, base)), fitted, max_features=MAX_TERMS)
    return rows.select("doc_id", "term", "w")


def split_documents(spark: SparkSession, base: str) -> DataFrame:
    """Token documents with an exact stratified 20 % test flag.  The cut-offs
    come from the id and label columns alone, without reading a text."""
    docs = prepared_documents(spark, base)
    return D.stratified_split(docs, 0.2)


@query
def tfidf_train_scope(spark, base):
    docs = split_documents(spark, base)
    tf = B.term_counts(docs, carry=("is_test",))
    train = tf.filter(~F.col("is_test"))
    n = B.document_count(docs.filter(~F.col("is_test")))
    fitted = TF.fit_tfidf(train, n, max_features=MAX_TERMS)
    return fitted.select("term", "idx", "df", "idf")


# --- retrieval ---------------------------------------------------------------

@query
def similar_docs(spark, base):
    """Every document whose id is divisible by 20 against all others.  Terms go by their
    number, half as long as their text."""
    rows = weights(spark, base, carry=("label",)).select("doc_id", "label", F.col("idx").alias("term"), "w")
    rows = materialize(rows, "weights", "doc_id")
    queries = materialize(rows.filter(F.col("doc_id") % 20 == 0)
                          .select(F.col("doc_id").alias("query_id"), "term", "w"), "queries")
    return R.similar_docs(queries, rows, 3)


@query
def retrieve_similar(spark, base):
    """Every benchmark text against all documents."""
    docs = prepared_documents(spark, base)
    tf = B.term_counts(docs, carry=("label",))
    fitted = materialize(TF.fit_tfidf(tf, B.document_count(docs), max_features=MAX_TERMS), "fitted")
    queries = TF.transform_tfidf(B.term_counts(query_texts(spark, base)), fitted, max_features=MAX_TERMS)
    queries = queries.select(F.col("doc_id").alias("query_id"), F.col("idx").alias("term"), "w")
    queries = materialize(queries, "queries")
    rows = TF.transform_tfidf(tf, fitted, carry=("label",), max_features=MAX_TERMS)
    rows = materialize(rows.select("doc_id", "label", F.col("idx").alias("term"), "w"), "weights", "doc_id")
    top = R.similar_docs(queries, rows, 5, exclude_self=False)
    hits = top.join(docs.select("doc_id", F.left("text_clean", F.lit(500)).alias("text")), "doc_id")
    return hits.select("query_id", "rank", "doc_id", "label", F.round("similarity", 4).alias("similarity"), "text")


@query
def neighbor_label_agreement(spark, base):
    return R.neighbor_label_agreement(similar_docs(spark, base),
                                      corpus(spark, base).select("doc_id", "label"))


# --- vectors -----------------------------------------------------------------

def vectors(spark: SparkSession, base: str) -> DataFrame:
    return spread(table(spark, base, "embeddings"), "vec_id").select(
        F.col("vec_id").alias("word"), F.col("embedding").alias("vector"))


@query
def context_pairs(spark, base):
    rows = E.context_pairs(prepared_documents(spark, base))
    return rows.select("doc_id", "pos", "center", F.array_join("context", " ").alias("context"))


@query
def word_similarity(spark, base):
    """Every vector with its successor; the last one has none."""
    pairs = table(spark, base, "embeddings").select(
        F.col("vec_id").alias("a"), (F.col("vec_id") + 1).alias("b"))
    return E.word_similarity(vectors(spark, base), pairs)


@query
def nearest_words(spark, base):
    """Five neighbours, among all, of every vector whose id is divisible by 20."""
    terms = table(spark, base, "embeddings").select("vec_id").filter(F.col("vec_id") % 20 == 0)
    return E.nearest_words(vectors(spark, base), terms)


@query
def top_words(spark, base):
    """Vectors whose id is a vocabulary index, by frequency of that term."""
    vocab = B.vocabulary(B.term_counts(prepared_documents(spark, base)))
    top = E.top_words(vocab.select(F.col("idx").cast("long").alias("word"), "cf"), vectors(spark, base))
    shown = F.transform("vector", lambda x: F.format_string("%.6f", x.cast("double")))
    return top.select("word", "cf", F.array_join(shown, " ").alias("vector"))


# --- n-gram language models --------------------------------------------------

LM_CLASSES = ("Real", "Fake")


def lm_split(spark: SparkSession, base: str) -> DataFrame:
    docs = D.keep_classes(prepared_documents(spark, base), LM_CLASSES)
    return D.stratified_split(docs, 100)


@query
def ngrams(spark, base):
    rows = L.ngrams(prepared_documents(spark, base), 3)
    return rows.groupBy("doc_id", "context", "word").agg(F.count(F.lit(1)).alias("n"))


@query
def ngram_counts(spark, base):
    return L.ngram_counts(prepared_documents(spark, base), 2)


@query
def ngram_context_counts(spark, base):
    return L.context_counts(L.ngram_counts(prepared_documents(spark, base), 2))


@query
def ngram_class_stats(spark, base):
    return L.class_stats(prepared_documents(spark, base))


@query
def unique_ngram_count(spark, base):
    docs = prepared_documents(spark, base)
    return D.union_sources(*[L.unique_ngram_count(L.ngram_counts(docs, n)).withColumn("n", F.lit(n))
                             for n in (1, 2, 3)])


@query
def top_ngrams(spark, base):
    return L.top_ngrams(L.ngram_counts(prepared_documents(spark, base), 2))


@query
def continuation_stats(spark, base):
    return L.continuation_stats(prepared_documents(spark, base))


def _lm_prob(name: str, n: int, smoothing: str, mode: str = "as_implemented") -> None:
    def build(spark, base):
        docs = lm_split(spark, base)
        model = L.fit_ngram_model(docs.filter(~F.col("is_test")), n, smoothing, mode=mode)
        grams = L.ngrams(docs.filter("is_test"), n).groupBy("context", "word").agg(
            F.count(F.lit(1)).alias("m"))
        scored = L.lm_prob(grams, model)
        return scored.select("context", "word", "m", *[
            F.round(F.ln(f"p_{c}"), 6).alias(f"log_p_{c}") for c in LM_CLASSES])
    build.__name__ = name
    query(build)


_lm_prob("lm_prob_none", 2, "none")
_lm_prob("lm_prob_laplace", 2, "laplace")
_lm_prob("lm_prob_laplace_unigram", 1, "laplace")
_lm_prob("lm_prob_kneser_ney", 2, "kneser_ney")
_lm_prob("lm_prob_kneser_ney_trigram", 3, "kneser_ney")
_lm_prob("lm_prob_kneser_ney_formula", 3, "kneser_ney", "formula")

LM_RUNS = ((1, "laplace"), (2, "laplace"), (3, "kneser_ney"))


def lm_scores(spark: SparkSession, base: str, runs) -> list[DataFrame]:
    """Perplexities of the held-out documents for each (order, smoothing), from
    one pass over the training and one over the held-out texts."""
    docs = lm_split(spark, base)
    train, test = docs.filter(~F.col("is_test")), docs.filter("is_test")
    trigrams, grams = L.trigram_table(train), L.document_trigrams(test, carry=("label",))
    return [L.perplexity(test, L.fit_ngram_model(train, n, s, trigrams=trigrams), carry=("label",), grams=grams)
            for n, s in runs]


@query
def perplexity(spark, base):
    return lm_scores(spark, base, [(2, "laplace")])[0]


@query
def classify_by_perplexity(spark, base):
    scored = L.classify_by_perplexity(lm_scores(spark, base, [(3, "kneser_ney")])[0])
    return scored.select("doc_id", "label", "prediction")


@query
def lm_evaluation(spark, base):
    runs = [L.classify_by_perplexity(scores).select("label", "prediction").withColumn("order", F.lit(n))
            for (n, _), scores in zip(LM_RUNS, lm_scores(spark, base, LM_RUNS))]
    return M.weighted_prf(D.union_sources(*runs), ["order"])


# --- Naive Bayes -------------------------------------------------------------

def nb_rows(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    docs = split_documents(spark, base)
    return docs, B.term_counts(docs, carry=("label", "is_test"), keep_empty=True)


def nb_params(docs: DataFrame, rows: DataFrame, weight: str = "tf"):
    sums = NB.class_sums(rows, weight, max_features=MAX_TERMS, train=~F.col("is_test"))
    return NB.nb_fit(sums), NB.nb_priors(docs.filter(~F.col("is_test")))


def nb_scores(spark: SparkSession, base: str) -> DataFrame:
    """Test documents with lp_, p_ per class and prediction."""
    docs, rows = nb_rows(spark, base)
    loglik, priors = nb_params(docs, rows)
    log_proba = NB.nb_log_proba(rows.filter("is_test"), loglik, priors, carry=("label",),
                                max_features=MAX_TERMS)
    return NB.nb_predict(NB.nb_proba(log_proba))


@query
def nb_fit(spark, base):
    docs, rows = nb_rows(spark, base)
    loglik, _ = nb_params(docs, rows)
    return NB.unpivot_classes(loglik, "ll_", "ll", ["term"])


@query
def nb_priors(spark, base):
    docs = D.stratified_split(corpus(spark, base).select("doc_id", "label"), 0.2)
    priors = NB.nb_priors(docs.filter(~F.col("is_test")))
    rows = docs.select("label").distinct()
    return rows.withColumn("p", priors).select("label", F.coalesce(*[
        F.when(F.col("label") == c, F.col(f"p.{c}")) for c in CLASSES]).alias("lp"))


@query
def nb_log_proba(spark, base):
    return NB.unpivot_classes(nb_scores(spark, base), "lp_", "lp", ["doc_id"])


@query
def nb_proba(spark, base):
    return NB.unpivot_classes(nb_scores(spark, base), "p_", "p", ["doc_id"])


@query
def nb_predict(spark, base):
    return nb_scores(spark, base).select("doc_id", "label", "prediction")


@query
def nb_accuracy(spark, base):
    return M.accuracy(nb_scores(spark, base))


@query
def nb_compare_inputs(spark, base):
    """Weighted F1 with counts and with TF-IDF weights; ties favour TF-IDF."""
    bow = nb_scores(spark, base).select("label", "prediction").withColumn("input", F.lit("bow"))
    docs, rows = nb_rows(spark, base)
    filled = rows.filter(F.col("term").isNotNull())
    fitted = TF.fit_tfidf(filled, B.document_count(docs), max_features=MAX_TERMS)
    w = TF.transform_tfidf(filled, fitted, carry=("label", "is_test"), max_features=MAX_TERMS)
    loglik, priors = nb_params(docs, w, "w")
    test = rows.filter("is_test")
    scored = NB.nb_log_proba(
        TF.transform_tfidf(test, fitted, carry=("label",), max_features=MAX_TERMS, keep_unknown=True),
        loglik, priors, "w", carry=("label",), max_features=MAX_TERMS)
    tfidf = NB.nb_predict(scored).select("label", "prediction").withColumn("input", F.lit("tfidf"))
    table_ = M.weighted_prf(D.union_sources(bow, tfidf), ["input"]).select("input", F.col("f1"))
    order = W.partitionBy().orderBy(settled(F.col("f1")).desc(), F.desc("input"))
    return table_.withColumn("best", F.row_number().over(order) == 1)


@query
def nb_alpha_sweep(spark, base):
    docs, rows = nb_rows(spark, base)
    return NB.nb_alpha_sweep(rows, docs, max_features=MAX_TERMS)


# --- evaluation --------------------------------------------------------------

@query
def accuracy(spark, base):
    return M.accuracy(nb_scores(spark, base))


@query
def per_class_prf(spark, base):
    return M.per_class_prf(nb_scores(spark, base)).drop("tp")


@query
def weighted_prf(spark, base):
    return M.weighted_prf(nb_scores(spark, base))


@query
def confusion_matrix(spark, base):
    return M.confusion_matrix(nb_scores(spark, base), CLASSES)


@query
def classification_report(spark, base):
    return M.classification_report(nb_scores(spark, base))


@query
def roc_points(spark, base):
    return M.roc_points(nb_scores(spark, base), CLASSES)


@query
def auc_ovr(spark, base):
    return M.auc_ovr(nb_scores(spark, base), CLASSES)


@query
def weighted_auc(spark, base):
    return M.weighted_auc(M.auc_ovr(nb_scores(spark, base), CLASSES))


@query
def misclassified(spark, base):
    return M.misclassified(nb_scores(spark, base)).select("doc_id", "label", "prediction")


@query
def misclassified_share(spark, base):
    return M.misclassified_share(nb_scores(spark, base))


def nb_scores_with_text(spark: SparkSession, base: str) -> DataFrame:
    texts = prepared_documents(spark, base).select("doc_id", "text_clean")
    return nb_scores(spark, base).select("doc_id", "label", "prediction").join(texts, "doc_id")


@query
def categorize_errors(spark, base):
    return M.categorize_errors(nb_scores_with_text(spark, base)).select(
        "doc_id", "label", "prediction", "category")


@query
def error_category_counts(spark, base):
    return M.error_category_counts(nb_scores_with_text(spark, base))
