"""TF-IDF weights as a long table.

Three variants, all scaled to unit length per document: `standard` uses
ln(n/df) + 1, `smooth` uses ln((1+n)/(1+df)) + 1, and `sublinear` adds
tf → 1 + ln tf to `smooth`.  Spark ML's IDF lacks the final + 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lexmill.operators.bow import MAX_FEATURES, restrict, vocabulary
from lexmill.plans.layout import settled

VARIANTS = ("standard", "smooth", "sublinear")


def fit_tfidf(tf: DataFrame, n_docs: Column, variant: str = "sublinear",
              max_features: int = MAX_FEATURES) -> DataFrame:
    """Fitted table (term, idx, cf, df, idf).  Pass training rows and their
    count to fit on a training set only."""
    return with_idf(vocabulary(tf, max_features), n_docs, variant)


def with_idf(vocab: DataFrame, n_docs: Column, variant: str = "sublinear") -> DataFrame:
    """A vocabulary with the inverse document frequencies of a variant."""
    if variant not in VARIANTS:
        raise ValueError(f"unknown TF-IDF variant: {variant}")
    n, df = n_docs.cast("double"), F.col("df").cast("double")
    ratio = n / df if variant == "standard" else (1 + n) / (1 + df)
    return vocab.withColumn("idf", F.ln(ratio) + 1)


def transform_tfidf(tf: DataFrame, fitted: DataFrame, variant: str = "sublinear",
                    key: str = "doc_id", max_features: int = MAX_FEATURES,
                    carry: Sequence[str] = (), keep_unknown: bool = False) -> DataFrame:
    """Unit-length weights (key, carry…, term, idx, tf, w); unknown terms drop,
    or keep their rows with weight 0 so that no document is lost.

    The norm is a window over the key.  Rows from `term_counts` already sit
    together by key, so no shuffle happens here.
    """
    known = restrict(tf, fitted.select("term", "idx", "idf"), max_features,
                     "left" if keep_unknown else "inner")
    scale = (1 + F.ln(F.greatest("tf", F.lit(1)))) if variant == "sublinear" else F.col("tf").cast("double")
    raw = known.withColumn("raw", scale * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(W.partitionBy(key)))
    w = F.when(F.col("raw").isNull(), F.lit(0.0)).otherwise(F.col("raw") / norm)
    return raw.select(key, *carry, "term", "idx", "tf", w.alias("w"))


def tfidf(tf: DataFrame, n_docs: Column, variant: str = "sublinear", key: str = "doc_id",
          max_features: int = MAX_FEATURES, carry: Sequence[str] = ()) -> DataFrame:
    """Fit and weight the same rows."""
    fitted = fit_tfidf(tf, n_docs, variant, max_features)
    return transform_tfidf(tf, fitted, variant, key, max_features, carry)


def discriminative_terms(weights: DataFrame, docs: DataFrame, classes: Sequence[str],
                         k: int = 15) -> DataFrame:
    """Terms by mean weight inside a class minus mean weight outside it.

    Absent terms count as zero: sums are divided by class sizes.  One shuffle
    of pre-combined sums per term serves all classes.
    """
    sizes = docs.agg(F.struct(*[F.sum((F.col("label") == c).cast("long")).alias(c) for c in classes],
                              F.count(F.lit(1)).alias("__all")).alias("s")).scalar()
    sums = weights.groupBy("term").agg(
        F.sum("w").alias("total"),
        *[F.coalesce(F.sum(F.when(F.col("label") == c, F.col("w"))), F.lit(0.0)).alias(f"in_{c}")
          for c in classes]).withColumn("s", sizes)

    def score(c: str) -> Column:
        inside, n = F.col(f"in_{c}"), F.col(f"s.{c}")
        return inside / n - (F.col("total") - inside) / (F.col("s.__all") - n)

    rows = sums.select("term", F.explode(F.array(*[
        F.struct(F.lit(c).alias("label"), score(c).alias("score"))
        for c in classes])).alias("x")).select("term", "x.label", "x.score")
    order = W.partitionBy("label").orderBy(settled(F.col("score")).desc(), "term")
    return (rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("label", "rank", "term", "score"))
