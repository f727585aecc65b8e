"""Evaluation from (label, prediction[, scores]) rows.

Predictions are first folded to one row per (label, prediction) pair, which
combines before the shuffle; every other figure is computed from that small
table.  `by` repeats the evaluation per run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lexmill.session import materialize


def pair_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def accuracy(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    hit = (F.col("label") == F.col("prediction")).cast("double")
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"))


def per_class_prf(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class, 0 where undefined."""
    pairs = pair_counts(df, by)
    same = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    sides = pairs.select(*by, F.explode(F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"),
                 F.lit(0).cast("long").alias("predicted"), same.cast("long").alias("tp")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp")))).alias("s"))
    sums = sides.select(*by, "s.*").groupBy(*by, "class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"),
        F.sum("tp").alias("tp"))
    p, r = _ratio(F.col("tp"), F.col("predicted")), _ratio(F.col("tp"), F.col("support"))
    return (sums.withColumn("precision", p).withColumn("recall", r)
            .withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"),
                                     F.col("precision") + F.col("recall")))
            .select(*by, "class", "precision", "recall", "f1", "support", "tp"))


def _weighted(col: str) -> Column:
    return F.sum(F.col(col) * F.col("support")) / F.sum("support")


def weighted_prf(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1."""
    return per_class_prf(df, by).groupBy(*by).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        *[_weighted(m).alias(m) for m in ("precision", "recall", "f1")])


def confusion_matrix(df: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Every (label, prediction) cell, zeros included."""
    wide = df.agg(*[F.sum(((F.col("label") == t) & (F.col("prediction") == p)).cast("long"))
                    .alias(f"{t}>{p}") for t in classes for p in classes])
    cells = F.array(*[F.struct(F.lit(t).alias("label"), F.lit(p).alias("prediction"),
                               F.coalesce(F.col(f"`{t}>{p}`"), F.lit(0).cast("long")).alias("n"))
                      for t in classes for p in classes])
    return wide.select(F.explode(cells).alias("c")).select("c.*")


def classification_report(df: DataFrame) -> DataFrame:
    """Per class, accuracy, macro and weighted rows with support."""
    per_class = per_class_prf(df)
    rows = per_class.select("class", "precision", "recall", "f1", "support")
    total = F.sum("support").alias("support")
    acc = F.sum("tp") / F.sum("support")
    summary = per_class.agg(
        F.struct(F.lit("accuracy").alias("class"), acc.alias("precision"), acc.alias("recall"),
                 acc.alias("f1"), total).alias("a"),
        F.struct(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                 F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), total).alias("b"),
        F.struct(F.lit("weighted avg").alias("class"), _weighted("precision").alias("precision"),
                 _weighted("recall").alias("recall"), _weighted("f1").alias("f1"), total).alias("c"))
    return rows.unionByName(summary.select(F.explode(F.array("a", "b", "c")).alias("s")).select("s.*"))


def _score_groups(df: DataFrame, classes: Sequence[str], by: Sequence[str], prefix: str) -> DataFrame:
    """Positives and negatives per (class, score), scores as they are."""
    one = F.explode(F.array(*[F.struct(
        F.lit(c).alias("class"), (F.col(f"{prefix}{c}") + F.lit(0.0)).alias("score"),
        (F.col("label") == c).cast("long").alias("hit")) for c in classes]))
    return (df.select(*by, one.alias("o")).select(*by, "o.*").groupBy(*by, "class", "score")
            .agg(F.sum("hit").alias("pos"), F.sum(1 - F.col("hit")).alias("neg")))


def _ranked_groups(df: DataFrame, classes: Sequence[str], by: Sequence[str], prefix: str) -> DataFrame:
    """Score groups with the positives and negatives of smaller scores
    (pos_under, neg_under) and of the whole class (pos_all, neg_all).

    The groups are ranged by (run, class, score).  Each range keeps its own sum,
    the few range sums give the offsets, and running sums stay inside a range,
    so a class with any number of distinct scores never meets in one task.
    """
    keys = [*by, "class"]
    ranged = _score_groups(df, classes, by, prefix).repartitionByRange(*keys, "score")
    groups = materialize(ranged.withColumn("__range", F.spark_partition_id()), "scores")
    sums = groups.groupBy(*keys, "__range").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    whole = W.partitionBy(*keys)
    before = whole.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(
        *keys, "__range",
        *[F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"{x}_before") for x in "pn"],
        F.sum("p").over(whole).alias("pos_all"), F.sum("n").over(whole).alias("neg_all"))
    inside = W.partitionBy(*keys, "__range").orderBy("score").rowsBetween(W.unboundedPreceding, -1)
    running = groups.withColumns({
        "pos_in": F.coalesce(F.sum("pos").over(inside), F.lit(0)),
        "neg_in": F.coalesce(F.sum("neg").over(inside), F.lit(0))})
    return running.join(offsets, [*keys, "__range"]).select(
        *keys, "score", "pos", "neg", "pos_all", "neg_all",
        (F.col("pos_in") + F.col("p_before")).alias("pos_under"),
        (F.col("neg_in") + F.col("n_before")).alias("neg_under"))


def roc_points(df: DataFrame, classes: Sequence[str], by: Sequence[str] = (),
               prefix: str = "p_") -> DataFrame:
    """One-vs-rest (class, threshold, fpr, tpr) at each distinct score."""
    ranked = _ranked_groups(df, classes, by, prefix)
    return ranked.select(
        *by, "class", F.col("score").alias("threshold"),
        ((F.col("neg_all") - F.col("neg_under")) / F.col("neg_all")).alias("fpr"),
        ((F.col("pos_all") - F.col("pos_under")) / F.col("pos_all")).alias("tpr"))


def auc_ovr(df: DataFrame, classes: Sequence[str], by: Sequence[str] = (),
            prefix: str = "p_") -> DataFrame:
    """One-vs-rest AUC and positives per class; exact rank statistic, ties
    counted half.  Null where a class has no positives or no negatives."""
    ranked = _ranked_groups(df, classes, by, prefix)
    wins = F.sum(F.col("pos") * (F.col("neg_under") + F.col("neg") / 2))
    pos, neg = F.sum("pos"), F.sum("neg")
    return ranked.groupBy(*by, "class").agg(
        F.when((pos > 0) & (neg > 0), wins / (pos * neg)).alias("auc"), pos.alias("support"))


def weighted_auc(aucs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return aucs.groupBy(*by).agg((F.sum(F.col("auc") * F.col("support"))
                                  / F.sum("support")).alias("roc_auc"))


def misclassified(df: DataFrame, n: int | None = None, key: str = "doc_id") -> DataFrame:
    """Rows predicted wrongly, the first n by key if n is given."""
    wrong = df.filter(F.col("label") != F.col("prediction"))
    return wrong if n is None else wrong.orderBy(key).limit(n)


def misclassified_share(df: DataFrame) -> DataFrame:
    miss = (F.col("label") != F.col("prediction")).cast("long")
    return df.agg(F.count(F.lit(1)).alias("total"), F.sum(miss).alias("misclassified"),
                  (F.sum(miss) * 100.0 / F.count(F.lit(1))).alias("pct"))


def error_category(label: Column, prediction: Column, text: Column) -> Column:
    """Heuristic reason of an error: the first rule that fits."""
    return (F.when(F.length(text) < 50, F.lit("SHORT_TEXT"))
            .when((label == "Satire") != (prediction == "Satire"), F.lit("SATIRE_CONFUSION"))
            .when((label == "Real") & (prediction == "Fake"), F.lit("SENSATIONAL_REAL"))
            .when((label == "Fake") & (prediction == "Real"), F.lit("FORMAL_FAKE"))
            .otherwise(F.lit("TOPIC_OVERLAP")))


def categorize_errors(df: DataFrame, text: str = "text_clean") -> DataFrame:
    wrong = misclassified(df)
    return wrong.withColumn("category", error_category(F.col("label"), F.col("prediction"), F.col(text)))


def error_category_counts(df: DataFrame, n: int = 30, text: str = "text_clean",
                          key: str = "doc_id") -> DataFrame:
    """Histogram of reasons over the first n errors, with percentages."""
    first = misclassified(df, n, key)
    category = error_category(F.col("label"), F.col("prediction"), F.col(text))
    counts = first.groupBy(category.alias("category")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(W.partitionBy()))
