"""Multinomial Naive Bayes with unsmoothed priors.

Parameters are one row per term with a column per class.  Scoring is one
broadcast join of the bounded vocabulary and one sum per class, done where the
document's rows already lie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lexmill.functions.wordlists import ALPHAS, CLASSES
from lexmill.operators.bow import MAX_FEATURES, restrict
from lexmill.operators.metrics import weighted_prf
from lexmill.plans.layout import settled


def class_sums(rows: DataFrame, weight: str = "tf", classes: Sequence[str] = CLASSES,
               max_features: int = MAX_FEATURES, train: Column | None = None) -> DataFrame:
    """(term, s_<class>…): summed weights of training rows per class.

    The vocabulary is chosen in the same aggregation: the `max_features` terms
    of largest total weight over all rows, ties by term.
    """
    train = F.lit(True) if train is None else train
    sums = rows.filter(F.col("term").isNotNull()).groupBy("term").agg(
        F.sum(weight).alias("total"),
        *[F.coalesce(F.sum(F.when(train & (F.col("label") == c), F.col(weight))), F.lit(0))
          .cast("double").alias(f"s_{c}") for c in classes])
    return sums.orderBy(F.desc("total"), "term").limit(max_features).drop("total")


def nb_fit(sums: DataFrame, alpha: float = 1.0, classes: Sequence[str] = CLASSES) -> DataFrame:
    """(term, ll_<class>…): ln((s + α) / (Σ s + α·V))."""
    everything = W.partitionBy()
    size = F.count(F.lit(1)).over(everything)
    return sums.select("term", *[
        F.ln((F.col(f"s_{c}") + alpha) / (F.sum(f"s_{c}").over(everything) + alpha * size))
        .alias(f"ll_{c}") for c in classes])


def nb_priors(docs: DataFrame, classes: Sequence[str] = CLASSES) -> Column:
    """Scalar struct of log class shares, null for a class without documents."""
    total = F.count(F.lit(1))
    shares = [F.sum((F.col("label") == c).cast("long")) / total for c in classes]
    return docs.agg(F.struct(*[
        F.when(p > 0, F.ln(p)).alias(c) for p, c in zip(shares, classes)]).alias("p")).scalar()


def nb_log_proba(rows: DataFrame, loglik: DataFrame, priors: Column, weight: str = "tf",
                 key: str = "doc_id", carry: Sequence[str] = (), classes: Sequence[str] = CLASSES,
                 max_features: int = MAX_FEATURES) -> DataFrame:
    """(key, carry…, lp_<class>…): log prior + Σ weight · log likelihood.

    Unknown terms add nothing; a document of unknown terms keeps the prior.
    """
    hits = restrict(rows, loglik, max_features, "left")
    sums = hits.groupBy(key, *carry).agg(*[
        F.sum(F.col(weight) * F.coalesce(F.col(f"ll_{c}"), F.lit(0.0))).alias(f"lp_{c}")
        for c in classes])
    scored = sums.withColumn("prior", priors)
    return scored.select(key, *carry, *[
        (F.col(f"lp_{c}") + F.col(f"prior.{c}")).alias(f"lp_{c}") for c in classes])


def best_class(scores: dict[str, Column]) -> Column:
    """Class of the largest score; ties go to the first class listed."""
    top = F.greatest(*scores.values()) if len(scores) > 1 else next(iter(scores.values()))
    pick = F.lit(None).cast("string")
    for name, score in reversed(list(scores.items())):
        pick = F.when(score >= top, F.lit(name)).otherwise(pick)
    return pick


def nb_proba(log_proba: DataFrame, classes: Sequence[str] = CLASSES) -> DataFrame:
    """Add p_<class>: probabilities, shifted by the maximum before exp."""
    top = F.greatest(*[F.col(f"lp_{c}") for c in classes])
    parts = {c: F.coalesce(F.exp(F.col(f"lp_{c}") - top), F.lit(0.0)) for c in classes}
    total = sum(parts.values(), F.lit(0.0))
    return log_proba.withColumns({f"p_{c}": parts[c] / total for c in classes})


def nb_predict(log_proba: DataFrame, classes: Sequence[str] = CLASSES) -> DataFrame:
    """Add `prediction`; classes are listed alphabetically."""
    return log_proba.withColumn("prediction", best_class({c: F.col(f"lp_{c}") for c in classes}))


def unpivot_classes(df: DataFrame, prefix: str, out: str, keep: Sequence[str],
                    classes: Sequence[str] = CLASSES) -> DataFrame:
    """Wide per-class columns to long rows (keep…, class, out)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("class"), F.col(f"{prefix}{c}").alias(out))
                                for c in classes]))
    return df.select(*keep, pairs.alias("x")).select(*keep, "x.class", f"x.{out}")


def nb_alpha_sweep(rows: DataFrame, docs: DataFrame, alphas: Sequence[float] = ALPHAS,
                   classes: Sequence[str] = CLASSES, max_features: int = MAX_FEATURES) -> DataFrame:
    """Test accuracy and weighted P/R/F1 per α, and the best α by F1.

    `rows` is (doc_id, label, is_test, term, tf), `docs` (label, is_test).  All
    strengths are fitted from one set of class sums and scored in one pass.
    """
    sums = class_sums(rows, "tf", classes, max_features, ~F.col("is_test"))
    everything = W.partitionBy()
    size = F.count(F.lit(1)).over(everything)
    params = sums.select("term", *[
        F.ln((F.col(f"s_{c}") + a) / (F.sum(f"s_{c}").over(everything) + a * size)).alias(f"ll_{i}_{c}")
        for i, a in enumerate(alphas) for c in classes])
    priors = nb_priors(docs.filter(~F.col("is_test")), classes)
    hits = restrict(rows.filter("is_test"), params, max_features, "left")
    scored = hits.groupBy("doc_id", "label").agg(*[
        F.sum(F.col("tf") * F.coalesce(F.col(f"ll_{i}_{c}"), F.lit(0.0))).alias(f"lp_{i}_{c}")
        for i in range(len(alphas)) for c in classes]).withColumn("prior", priors)
    runs = F.explode(F.array(*[
        F.struct(F.lit(float(a)).alias("alpha"), best_class({
            c: F.col(f"lp_{i}_{c}") + F.col(f"prior.{c}") for c in classes
        }).alias("prediction")) for i, a in enumerate(alphas)]))
    predictions = scored.select("label", runs.alias("r")).select("label", "r.alpha", "r.prediction")
    table = weighted_prf(predictions, ["alpha"])
    best = F.row_number().over(W.partitionBy().orderBy(settled(F.col("f1")).desc(), "alpha")) == 1
    return table.withColumn("best", best)
