"""Term, n-gram and class counts of a growing corpus, kept by signed changes.

A state is one additive table (kind, label, context, word, n_docs, n):

    class   documents of a label (context and word empty)
    term    documents that hold a word, and its occurrences
    gram    documents that hold a bigram with sentence markers, and its occurrences

A change is documents with a sign: +1 for new ones, −1 for withdrawn ones, both
for revised ones.  Counts are sums, so the next state is the last one plus the
signed counts of the change: only the changed texts are read.  States are
committed versions: a refresh that is repeated, or runs beside another one of the
same version, is refused instead of counted twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexmill.operators.bow import MAX_FEATURES, most_frequent
from lexmill.operators.ngrams import END, START
from lexmill.operators.tfidf import with_idf
from lexmill.plans.layout import by_document, scalar
from lexmill.sources.lake import read_version, write_version

LAYER = "processed"
_KEYS = ("kind", "label", "context", "word")


def signed_counts(changes: DataFrame, tokens: str = "tokens", key: str = "doc_id") -> DataFrame:
    """Counts of (key, label, tokens, sign) rows, one read of the tokens for all
    kinds; a key stands once for each sign.  Documents are laid out by key, so only sums over documents, combined
    in each task first, are shuffled.  Null tokens count as none."""
    words = F.coalesce(tokens, F.array().cast("array<string>"))
    laid = by_document(changes.select(key, "label", "sign", words.alias("t")), key)
    padded = F.concat(F.array(F.lit(START)), F.col("t"), F.array(F.lit(END)))
    item = lambda kind, context, word: F.struct(
        F.lit(kind).alias("kind"), context.alias("context"), word.alias("word"))
    pairs = F.zip_with(F.slice("p", F.lit(1), F.size("p") - 1), F.slice("p", F.lit(2), F.size("p") - 1),
                       lambda a, b: item("gram", a, b))
    items = F.concat(F.array(item("class", F.lit(""), F.lit(""))),
                     F.transform("t", lambda w: item("term", F.lit(""), w)), pairs)
    one = (laid.withColumn("p", padded).select(key, "label", "sign", F.explode(items).alias("i"))
           .groupBy(key, "label", "sign", "i").agg(F.count(F.lit(1)).alias("c")))
    return one.groupBy("i.kind", "label", "i.context", "i.word").agg(
        F.sum(F.col("sign").cast("long")).alias("n_docs"), F.sum(F.col("sign") * F.col("c")).alias("n"))


def refresh(spark: SparkSession, base: str, name: str, version: str, changes: DataFrame,
            since: str | None = None) -> DataFrame:
    """Commit the state `version`: that of `since` (none: an empty corpus) plus the
    changes.  What falls to zero goes; a count below zero fails the refresh, as
    something was withdrawn that had not been counted."""
    counts = signed_counts(changes)
    if since is not None:
        counts = read_version(spark, base, LAYER, name, since).unionByName(counts)
    total = counts.groupBy(*_KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n"))
    checked = F.when((F.col("n_docs") > 0) & (F.col("n") >= F.col("n_docs")), F.col("n")).otherwise(
        F.raise_error(F.concat(F.lit("withdrawn but never counted: "), F.col("word"))).cast("long"))
    write_version(total.filter((F.col("n") != 0) | (F.col("n_docs") != 0)).withColumn("n", checked),
                  base, LAYER, name, version)
    return read_version(spark, base, LAYER, name, version)


def documents_of(state: DataFrame) -> Column:
    """Number of documents, as a scalar subquery."""
    return scalar(state.filter("kind = 'class'").agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n")), F.col("n"))


def terms_of(state: DataFrame) -> DataFrame:
    """(label, term, df, tf): what the class sums of Naive Bayes are taken from."""
    return state.filter("kind = 'term'").select(
        "label", F.col("word").alias("term"), F.col("n_docs").alias("df"), F.col("n").alias("tf"))


def ngrams_of(state: DataFrame) -> DataFrame:
    """(label, context, word, c), as `ngram_counts` gives them for bigrams."""
    return state.filter("kind = 'gram'").select("label", "context", "word", F.col("n").alias("c"))


def vocabulary_of(state: DataFrame, variant: str = "sublinear", max_features: int = MAX_FEATURES) -> DataFrame:
    """The fitted table (term, idx, cf, df, idf) of a state."""
    stats = terms_of(state).groupBy("term").agg(F.sum("tf").alias("cf"), F.sum("df").alias("df"))
    return with_idf(most_frequent(stats, max_features), documents_of(state), variant)
