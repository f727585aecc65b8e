"""Multinomial logistic regression with Spark ML on sparse TF-IDF vectors."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from lexmill.functions.wordlists import CLASSES
from lexmill.operators.bayes import best_class
from lexmill.operators.embeddings import beside_doc_vectors, concat_features
from lexmill.operators.metrics import per_class_prf, weighted_prf
from lexmill.plans.layout import settled
from lexmill.session import materialize

# Share of the L1 penalty per kind.
L1_RATIO = {"l1": 1.0, "l2": 0.0, "elasticnet": 0.5}


def sparse_vectors(weights: DataFrame, size: int, carry: Sequence[str] = ("label", "is_test"),
                   key: str = "doc_id", name: str = "vectors") -> DataFrame:
    """One sparse ML vector per document, as a written table.

    `weights` is (key, carry…, idx, w); a row with null idx keeps its document.
    The rows of a document are folded where they lie, written in the vector
    type's storage layout, and read back as vectors, so no Python is involved
    and repeated passes of a fit read a table instead of redoing the features.
    """
    cells = F.sort_array(F.collect_list(F.when(F.col("idx").isNotNull(), F.struct("idx", "w"))))
    rows = weights.groupBy(key, *carry).agg(cells.alias("cells"))
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
        F.transform("cells", lambda c: c["idx"]).alias("indices"),
        F.transform("cells", lambda c: c["w"]).alias("values"))
    rows = rows.select(key, *carry, vector.alias("features"))
    schema = T.StructType([f for f in rows.schema.fields if f.name != "features"]
                          + [T.StructField("features", VectorUDT())])
    return materialize(rows, name, schema=schema)


def vector_cells(vectors: DataFrame, key: str = "doc_id", features: str = "features") -> DataFrame:
    """(key, i, value): the entries of sparse or dense ML vectors that are not
    zero, read from the vectors' storage layout, so nothing is made dense."""
    layout = T.StructType([
        T.StructField("type", T.ByteType()), T.StructField("size", T.IntegerType()),
        T.StructField("indices", T.ArrayType(T.IntegerType())), T.StructField("values", T.ArrayType(T.DoubleType()))])
    raw = materialize(vectors.select(key, features), "cells", schema=T.StructType(
        [vectors.schema[key], T.StructField(features, layout)]))
    at = F.coalesce(F.col(f"{features}.indices"), F.sequence(F.lit(0), F.size(f"{features}.values") - 1))
    cells = raw.select(key, F.explode(F.arrays_zip(at.alias("i"), F.col(f"{features}.values").alias("value"))).alias("c"))
    return cells.select(key, "c.i", "c.value").filter(F.col("value") != 0)


def _with_index(df: DataFrame, classes: Sequence[str]) -> DataFrame:
    names = F.array(*[F.lit(c) for c in classes])
    return df.withColumn("label_idx", (F.array_position(names, F.col("label")) - 1).cast("double"))


def lr_fit(train: DataFrame, kind: str = "l2", C: float = 1.0, classes: Sequence[str] = CLASSES,
           max_iter: int = 2000, tol: float = 1e-4, features: str = "features") -> LogisticRegressionModel:
    """Fit with penalty strength 1/C on the summed loss.  Spark averages the
    loss, so its parameter is 1 / (C · n).

    Every iteration is a job over the partitions of `train`.
    """
    n = train.count()
    lr = LogisticRegression(
        featuresCol=features, labelCol="label_idx", family="multinomial", standardization=False,
        elasticNetParam=L1_RATIO[kind], regParam=1.0 / (C * n), maxIter=max_iter, tol=tol)
    return lr.fit(_with_index(train, classes).select(features, "label_idx"))


def lr_score(model: LogisticRegressionModel, df: DataFrame, classes: Sequence[str] = CLASSES) -> DataFrame:
    """Add p_<class>, prediction, confidence and the class → probability map."""
    p = vector_to_array("probability")
    out = model.transform(df).withColumns({f"p_{c}": F.get(p, i) for i, c in enumerate(classes)})
    scores = {c: F.col(f"p_{c}") for c in classes}
    pairs = [x for c in classes for x in (F.lit(c), F.col(f"p_{c}"))]
    return (out.withColumn("prediction", best_class(scores))
            .withColumn("confidence", F.greatest(*scores.values()))
            .withColumn("class_probabilities", F.create_map(*pairs))
            .drop("rawPrediction", "probability"))


def lr_variants(vectors: DataFrame, kinds: Sequence[str] = ("l1", "l2", "elasticnet"),
                C: float = 1.0, classes: Sequence[str] = CLASSES, max_iter: int = 2000) -> DataFrame:
    """Test accuracy and weighted scores of each penalty, best by F1."""
    train, test = vectors.filter(~F.col("is_test")), vectors.filter("is_test")
    runs = [lr_score(lr_fit(train, k, C, classes, max_iter), test, classes)
            .select(F.lit(k).alias("variant"), "label", "prediction") for k in kinds]
    table = weighted_prf(reduce(DataFrame.unionByName, runs), ["variant"])
    order = W.partitionBy().orderBy(settled(F.col("f1")).desc(), "variant")
    return table.withColumn("best", F.row_number().over(order) == 1)


def coefficients(model: LogisticRegressionModel, vocab: DataFrame,
                 classes: Sequence[str] = CLASSES) -> DataFrame:
    """(term, coef_<class>…): classes × vocabulary numbers, which Spark ML
    already holds on the driver."""
    matrix = model.coefficientMatrix.toArray()
    rows = [(i, *[float(x) for x in matrix[:, i]]) for i in range(matrix.shape[1])]
    schema = "idx int, " + ", ".join(f"`coef_{c}` double" for c in classes)
    return vocab.sparkSession.createDataFrame(rows, schema).join(
        vocab.select("idx", "term"), "idx").drop("idx")


def lr_top_features(coefs: DataFrame, k: int = 20, classes: Sequence[str] = CLASSES) -> DataFrame:
    """Largest |coefficient| per class, with its sign."""
    rows = coefs.select("term", F.explode(F.array(*[F.struct(
        F.lit(c).alias("label"), F.col(f"coef_{c}").alias("coef")) for c in classes])).alias("x"))
    order = W.partitionBy("label").orderBy(F.abs("coef").desc(), "term")
    return (rows.select("term", "x.*").withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= k)
            .withColumn("sign", F.when(F.col("coef") > 0, "+").otherwise("-")))


def feature_set_comparison(vectors: DataFrame, doc_vectors: DataFrame, C: float = 1.0,
                           classes: Sequence[str] = CLASSES, max_iter: int = 1000) -> DataFrame:
    """Weighted and per-class F1 and width for TF-IDF, mean word vectors, both."""
    both = concat_features(beside_doc_vectors(vectors, doc_vectors), ["terms", "words"])
    train, test = both.filter(~F.col("is_test")), both.filter("is_test")
    runs = []
    for name, col in (("tfidf", "terms"), ("word2vec", "words"), ("both", "features")):
        model = lr_fit(train, "l2", C, classes, max_iter, features=col)
        scored = lr_score(model, test, classes)
        runs.append(scored.select(F.lit(name).alias("features"), F.lit(model.numFeatures).alias("dim"),
                                  "label", "prediction"))
    by = ["features", "dim"]
    rows = reduce(DataFrame.unionByName, runs)
    per_class = per_class_prf(rows, by)
    return per_class.groupBy(*by).agg(
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"),
        *[F.max(F.when(F.col("class") == c, F.col("f1"))).alias(f"f1_{c}") for c in classes])


def explain_scores(weights: DataFrame, coefs: DataFrame, predictions: DataFrame, k: int = 10,
                   key: str = "doc_id",
                   classes: Sequence[str] = CLASSES) -> DataFrame:
    """Top-k contributions weight · coefficient of the predicted class.

    Windows run inside single documents; zero contributions are left out.
    """
    coef = F.lit(None).cast("double")
    for c in classes:
        coef = F.when(F.col("prediction") == c, F.col(f"coef_{c}")).otherwise(coef)
    rows = (weights.select(key, "term", "w").join(predictions.select(key, "prediction"), key)
            .join(coefs, "term")
            .select(key, "term", (F.col("w") * coef).alias("contribution"))
            .filter(F.col("contribution") != 0))
    order = W.partitionBy(key).orderBy(settled(F.abs("contribution")).desc(), "term")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
