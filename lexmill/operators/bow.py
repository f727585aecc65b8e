"""Bag of words as a long table (doc, term, tf)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lexmill.functions.tokenizers import counted
from lexmill.plans.layout import broadcast_if_bounded, by_document, scalar
from lexmill.session import materialize

MAX_FEATURES = 10_000


def document_count(docs: DataFrame) -> Column:
    """Number of documents, empty ones included, as a scalar subquery."""
    return scalar(docs.agg(F.count(F.lit(1)).alias("n")), F.col("n"))


def term_counts(docs: DataFrame, tokens: str = "tokens", key: str = "doc_id",
                carry: Sequence[str] = (), keep_empty: bool = False,
                split: Callable[[Column], Column] | None = None) -> DataFrame:
    """(key, carry…, term, tf).

    Documents are laid out by key, and the rows of one key are put together.
    Terms are then counted inside the array of their document, so a task holds no
    table of the terms of its documents.  `carry` columns depend on the key.
    With `keep_empty` a document without tokens keeps one row: null term, tf 0.
    With `split` the column holds texts, split after the rows of a key were put
    together: a text is a fraction of its tokens to sort and move.
    """
    return unfolded(_counted(docs, tokens, key, carry, split), keep_empty)


def _counted(docs: DataFrame, tokens: str, key: str, carry: Sequence[str],
             split: Callable[[Column], Column] | None = None) -> DataFrame:
    laid = by_document(docs.select(key, *carry, tokens), key)
    together = F.collect_list(tokens)
    whole = laid.groupBy(key, *carry).agg(
        F.count(F.lit(1)).cast("int").alias("n_rows"),
        F.flatten(F.transform(together, split) if split else together).alias("__t"))
    return whole.select(key, *carry, "n_rows", counted(F.col("__t")).alias("counts"))


def counted_documents(docs: DataFrame, tokens: str = "tokens", key: str = "doc_id",
                      carry: Sequence[str] = (), name: str = "counted",
                      split: Callable[[Column], Column] | None = None) -> DataFrame:
    """(key, carry…, n_rows, counts) as a written table, laid out by key.

    For jobs that pass over the terms more than once: `unfolded` gives the rows of
    `term_counts`, `document_rows` the rows counted, and no text is read again.
    """
    return materialize(_counted(docs, tokens, key, carry, split), name, key)


def unfolded(counts: DataFrame, keep_empty: bool = False) -> DataFrame:
    """(key, carry…, term, tf) of counted documents."""
    carried = [c for c in counts.columns if c not in ("n_rows", "counts")]
    unfold = F.inline_outer if keep_empty else F.inline
    return counts.select(*carried, unfold("counts")).withColumn("tf", F.coalesce("tf", F.lit(0)))


def document_rows(counts: DataFrame) -> DataFrame:
    """(key, carry…) of counted documents, one row for each row that was counted."""
    carried = [c for c in counts.columns if c not in ("n_rows", "counts")]
    return counts.select(*carried, F.explode(F.array_repeat(F.lit(1), F.col("n_rows"))).alias("__one")).drop("__one")


def vocabulary(tf: DataFrame, max_features: int = MAX_FEATURES) -> DataFrame:
    """The most frequent terms (ties by term) with an alphabetical index.

    Counts combine before the shuffle; the limit is a distributed top-n, and
    the index window sees at most `max_features` rows.
    """
    return most_frequent(tf.groupBy("term").agg(F.sum("tf").alias("cf"), F.count(F.lit(1)).alias("df")), max_features)


def most_frequent(stats: DataFrame, max_features: int = MAX_FEATURES) -> DataFrame:
    """The vocabulary of counted terms (term, cf, df)."""
    top = stats.orderBy(F.desc("cf"), "term").limit(max_features)
    idx = (F.row_number().over(W.partitionBy().orderBy("term")) - 1).cast("int")
    return top.select("term", idx.alias("idx"), "cf", "df")


def restrict(tf: DataFrame, vocab: DataFrame, max_features: int = MAX_FEATURES,
             how: str = "inner") -> DataFrame:
    """Join the bounded vocabulary to term rows without moving them."""
    return tf.join(broadcast_if_bounded(vocab, max_features), "term", how)


def matrix_stats(tf: DataFrame, vocab: DataFrame, n_docs: Column,
                 max_features: int = MAX_FEATURES) -> DataFrame:
    """Documents, features, non-zeros, sparsity and density in percent."""
    nnz = vocab.agg(F.count(F.lit(1)).alias("n_features"), F.sum("df").alias("nnz"))
    cells = F.col("n_docs") * F.col("n_features")
    return (nnz.select(n_docs.alias("n_docs"), "n_features", "nnz")
            .withColumn("sparsity_pct", (1 - F.col("nnz") / cells) * 100)
            .withColumn("density_pct", F.col("nnz") / cells * 100))


def top_terms_per_class(tf: DataFrame, k: int = 30) -> DataFrame:
    """The k terms with the highest total count in each class."""
    totals = tf.groupBy("label", "term").agg(F.sum("tf").alias("freq"))
    order = W.partitionBy("label").orderBy(F.desc("freq"), "term")
    return (totals.withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= k).select("label", "rank", "term", "freq"))


def export_vocabulary(vocab: DataFrame, n: int = 100) -> DataFrame:
    return vocab.select("term", "idx").orderBy("idx").limit(n)


def indexed(stats: DataFrame) -> DataFrame:
    """(term, idx, cf, df): every term with its place by frequency, ties by term.

    Terms are ranged; each range ranks its own and starts after the ranges before it,
    so neither a task nor the driver holds a vocabulary, however large.
    """
    order = [F.desc("cf"), F.asc("term")]
    ranged = materialize(stats.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy().orderBy("part")) - F.col("n")
    inside = F.row_number().over(W.partitionBy("part").orderBy(*order)) - 1
    return (ranged.withColumn("inside", inside).join(sizes.select("part", before.alias("before")), "part")
            .select("term", (F.col("before") + F.col("inside")).cast("int").alias("idx"), "cf", "df"))


def count_vectors(docs: DataFrame, tokens: str = "tokens", max_features: int | None = MAX_FEATURES,
                  min_df: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Sparse count vectors for Spark ML, one for each row of `docs`, and their
    vocabulary (term, idx, cf, df), indexed by frequency.

    `max_features` None keeps every term.  `min_df` is a number of documents, or a
    share of them below one.  The vocabulary is a table, not a model on the driver.
    """
    from lexmill.operators.logistic import sparse_vectors

    rest = [c for c in docs.columns if c != tokens]
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("__row"), *rest,
                                   counted(F.col(tokens)).alias("__c")), "counts", "__row")
    cells = rows.select("__row", F.inline_outer("__c"))
    stats = cells.filter(F.col("term").isNotNull()).groupBy("term").agg(
        F.sum("tf").alias("cf"), F.count(F.lit(1)).alias("df"))
    least = F.lit(min_df) if min_df >= 1 else F.lit(min_df) * document_count(rows)
    stats = stats.filter(F.col("df") >= least)
    if max_features is not None:
        stats = stats.orderBy(F.desc("cf"), "term").limit(max_features)
    vocab = materialize(indexed(stats), "indexed")
    known = cells.join(vocab.select("term", "idx"), "term", "left")
    vectors = sparse_vectors(known.select("__row", "idx", F.col("tf").cast("double").alias("w")),
                             vocab.count(), (), "__row", "count_vectors")
    return vocab, rows.drop("__c").join(vectors, "__row").drop("__row")
