"""Scoring new texts in batch, and request accounting."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lexmill.functions.cleaning import clean_text
from lexmill.functions.tokenizers import TOKENIZERS
from lexmill.functions.wordlists import CLASSES
from lexmill.operators import bayes as NB, bow as B, logistic as LR, tfidf as TF
from lexmill.operators.corpus import length_reason, validate_batches
from lexmill.operators.experiments import model_tokens
from lexmill.plans.layout import settled
from lexmill.session import materialize

# Requests allowed per client and clock minute.
SINGLE_QUOTA, BATCH_QUOTA = 100, 10


@dataclass(frozen=True)
class ScoringModel:
    """One fitted table, (term, idx, idf, ll_<class>…, coef_<class>…), and one
    row with the struct column p, the start value of each class.

    A text's score under a class is the start value plus the sum of weight · ll;
    its explanation is weight · coef.  Naive Bayes has log likelihoods and log
    priors there, logistic regression coefficients and intercepts.
    """

    params: DataFrame
    priors: DataFrame
    max_features: int
    classes: tuple[str, ...] = CLASSES


def text_tokens(text_clean: Column) -> Column:
    return model_tokens(TOKENIZERS["contractions"](text_clean))


def fit_scoring_model(docs: DataFrame, max_features: int = B.MAX_FEATURES,
                      classes: Sequence[str] = CLASSES, kind: str = "bayes") -> ScoringModel:
    """Naive Bayes, or `kind` "logistic", on TF-IDF of (doc_id, label,
    text_clean), written as tables.

    The explaining coefficients of Naive Bayes are its log likelihoods, centred
    over the classes.  Texts are read once: their counted terms are written.
    """
    counts = B.counted_documents(docs, "text_clean", carry=("label",), name="model_counts", split=text_tokens)
    rows, keep_empty = B.document_rows(counts), kind == "logistic"
    tf = B.unfolded(counts, keep_empty)
    known = tf.filter(F.col("term").isNotNull())
    fitted = materialize(TF.fit_tfidf(known, B.document_count(rows), max_features=max_features), "fitted")
    w = TF.transform_tfidf(tf, fitted, carry=("label",), max_features=max_features, keep_unknown=keep_empty)
    if kind == "logistic":
        model = LR.lr_fit(LR.sparse_vectors(w, max_features, ("label",)), classes=classes)
        return logistic_scoring_model(model, fitted, max_features, classes)
    if kind != "bayes":
        raise ValueError(f"unknown scoring model: {kind}")
    loglik = NB.nb_fit(NB.class_sums(w, "w", classes, max_features), 1.0, classes)
    mean = sum((F.col(f"ll_{c}") for c in classes), F.lit(0.0)) / len(classes)
    coefs = [(F.col(f"ll_{c}") - mean).alias(f"coef_{c}") for c in classes]
    params = fitted.select("term", "idx", "idf").join(loglik, "term").select(
        "term", "idx", "idf", *[f"ll_{c}" for c in classes], *coefs)
    one = rows.agg(F.lit(1).alias("one")).select(NB.nb_priors(rows, classes).alias("p"))
    return ScoringModel(materialize(params, "params"), materialize(one, "priors"), max_features, tuple(classes))


def logistic_scoring_model(model: LogisticRegressionModel, fitted: DataFrame, max_features: int,
                           classes: Sequence[str] = CLASSES) -> ScoringModel:
    """A fitted or loaded logistic regression over the terms of `fitted`."""
    coefs = LR.coefficients(model, fitted, classes)
    params = fitted.select("term", "idx", "idf").join(coefs, "term").select(
        "term", "idx", "idf", *[F.col(f"coef_{c}").alias(f"ll_{c}") for c in classes],
        *[f"coef_{c}" for c in classes])
    starts = F.struct(*[F.lit(float(b)).alias(c) for b, c in zip(model.interceptVector.toArray(), classes)])
    one = fitted.sparkSession.range(1).select(starts.alias("p"))
    return ScoringModel(materialize(params, "params"), materialize(one, "priors"), max_features, tuple(classes))


def accepted_texts(df: DataFrame, text: str = "text") -> DataFrame:
    return df.filter(length_reason(F.col(text)).isNull())


def score_texts(df: DataFrame, model: ScoringModel, key: str = "doc_id", k: int = 10) -> DataFrame:
    """Accepted texts → prediction, confidence, class_probabilities and
    top_features (a list of term → contribution maps).

    Texts move once, to be laid out by key.  One join brings idf, weights and
    coefficients of the bounded vocabulary to the terms; one aggregate a text
    sums its length and scores, not yet scaled to unit length, and holds its terms,
    from which the contributions to the predicted class are ranked.
    """
    rows = accepted_texts(df).select(key, clean_text(F.col("text")).alias("text_clean"))
    tf = B.term_counts(rows, "text_clean", key, keep_empty=True, split=text_tokens)
    known = B.restrict(tf, model.params, model.max_features, "left")
    raw = known.withColumn("raw", (1 + F.ln(F.greatest("tf", F.lit(1)))) * F.col("idf"))
    term = F.struct("term", *[(F.col("raw") * F.col(f"coef_{c}")).alias(c) for c in model.classes])
    sums = raw.groupBy(key).agg(
        F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"),
        *[F.sum(F.col("raw") * F.col(f"ll_{c}")).alias(f"s_{c}") for c in model.classes],
        F.collect_list(F.when(F.col("idx").isNotNull(), term)).alias("terms"))
    scored = sums.withColumn("p", model.priors.select("p").scalar()).select(key, "norm", "terms", *[
        (F.coalesce(F.col(f"s_{c}") / F.col("norm"), F.lit(0.0)) + F.col(f"p.{c}")).alias(f"lp_{c}") for c in model.classes])
    scored = NB.nb_predict(NB.nb_proba(scored, model.classes), model.classes)

    def share(t: Column) -> Column:
        value = F.lit(None).cast("double")
        for c in model.classes:
            value = F.when(F.col("prediction") == c, t.getField(c)).otherwise(value)
        return value / F.col("norm")

    shares = F.transform("terms", lambda t: F.struct(
        (-settled(F.abs(share(t)))).alias("order"), t["term"].alias("term"), share(t).alias("share")))
    top = F.slice(F.array_sort(F.filter(shares, lambda x: x["share"] != 0)), 1, k)
    p = {c: F.col(f"p_{c}") for c in model.classes}
    pairs = [x for c in model.classes for x in (F.lit(c), p[c])]
    return scored.select(
        key, "prediction", F.greatest(*p.values()).alias("confidence"),
        F.create_map(*pairs).alias("class_probabilities"),
        F.transform(top, lambda x: F.create_map(x["term"], x["share"])).alias("top_features"))


def score_batches(df: DataFrame, model: ScoringModel, batch: str = "batch_id", idx: str = "idx",
                  headers: DataFrame | None = None) -> DataFrame:
    """Per batch: verdict, first bad member, and class totals.

    As in the service, one bad member rejects its whole batch.
    """
    verdicts = validate_batches(df, batch, idx, headers=headers)
    good = verdicts.filter("accepted").select(batch)
    member = F.struct(F.col(batch).alias("batch"), F.col(idx).alias("idx"))
    texts = df.join(good, batch, "left_semi").select(member.alias("doc_id"), batch, "text")
    scored = score_texts(texts, model).select("doc_id", "prediction", "confidence")
    totals = (scored.groupBy(F.col("doc_id.batch").alias(batch)).agg(
                  F.count(F.lit(1)).alias("total_texts"), F.avg("confidence").alias("avg_confidence"),
                  *[F.sum((F.col("prediction") == c).cast("long")).alias(f"n_{c}") for c in model.classes]))
    return verdicts.join(totals, batch, "left")


def request_summary(log: DataFrame) -> DataFrame:
    """Per path and status: requests, share of errors, mean and tail times.

    Requests fold to one count per distinct time before they are ranked; the
    percentiles interpolate between the times at the two ranks around them.
    """
    bad = ((F.col("kind") == "ERROR") | (F.coalesce("status", F.lit(0)) >= 400)).cast("long")
    times = log.filter(F.col("kind") != "REQUEST").groupBy("path", "status", "ms").agg(
        F.count(F.lit(1)).alias("n"), F.sum(bad).alias("bad"))
    timed = F.when(F.col("ms").isNotNull(), F.col("n")).otherwise(F.lit(0))
    whole = W.partitionBy("path", "status")
    ranked = times.withColumn("upto", F.sum(timed).over(whole.orderBy("ms"))).withColumn(
        "timed", F.sum(timed).over(whole))

    def percentile(q: float) -> Column:
        at = F.lit(q) * (F.max("timed") - 1)
        low, high = (F.min(F.when(F.col("ms").isNotNull() & (F.col("upto") > f(F.lit(q) * (F.col("timed") - 1))),
                                  F.col("ms"))) for f in (F.floor, F.ceil))
        return low + (high - low) * (at - F.floor(at))

    total = F.sum("n")
    return ranked.groupBy("path", "status").agg(
        total.alias("n"), (F.sum("bad") / total).alias("error_share"),
        (F.sum(F.col("ms") * F.col("n")) / F.max("timed")).alias("mean_ms"),
        percentile(0.5).alias("p50_ms"), percentile(0.95).alias("p95_ms"))


def quota_audit(events: DataFrame, limit: int = SINGLE_QUOTA, client: str = "user_id",
                ts: str = "ts", width: str = "1 minute") -> DataFrame:
    """Requests per client and clock minute, and how many exceed the limit."""
    counts = events.groupBy(client, F.window(ts, width).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(client, F.col("w.start").alias("minute"), "n",
                         F.greatest(F.col("n") - limit, F.lit(0)).alias("over_limit"))
