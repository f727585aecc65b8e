"""Two-dimensional projection, polynomial features, scaling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations_with_replacement
from operator import mul

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from lexmill.functions.wordlists import CLASSES
from lexmill.operators.logistic import lr_fit, lr_score, vector_cells
from lexmill.operators.metrics import weighted_prf
from lexmill.plans.layout import broadcast_if_bounded
from lexmill.session import materialize

# A block of the iteration has this many rows at most.
MAX_TERMS_ON_DRIVER = 100_000


def _gram_product(cells: DataFrame, block: np.ndarray) -> np.ndarray:
    """XᵀX times a block of few columns, from the entries (doc_id, i, value) of X.

    The block has a row per vocabulary term, which bounds what is broadcast and
    what comes back.  Entries lie by document, so the inner products of a
    document are a window without a shuffle; the outer sums combine first.
    """
    spark, columns = cells.sparkSession, [f"b{j}" for j in range(block.shape[1])]
    side = spark.createDataFrame(pd.DataFrame(block, columns=columns).rename_axis("i").reset_index())
    met = cells.join(broadcast_if_bounded(side, len(block)), "i")
    row = W.partitionBy("doc_id")
    met = met.select("i", "value", *[F.sum(F.col("value") * F.col(b)).over(row).alias(b) for b in columns])
    sums = met.groupBy("i").agg(*[F.sum(F.col("value") * F.col(b)).alias(b) for b in columns]).toPandas()
    out = np.zeros_like(block)
    out[sums["i"].to_numpy(dtype=int)] = sums[columns].to_numpy()
    return out


def pca2(df: DataFrame, k: int = 2, features: str = "features", passes: int = 12,
         tolerance: float = 1e-7) -> tuple[DataFrame, list[float]]:
    """Centred principal components pc1…pck, and explained-variance ratios.

    Block Krylov iteration: every pass multiplies the covariance with a block of
    k + 6 columns, spread over the cluster, and the driver keeps terms × passes
    numbers, never a terms × terms matrix.  It ends when the residuals of the k
    components are below `tolerance` of the largest variance.  Components point
    so that their largest entry is positive.
    """
    cells = materialize(vector_cells(df, features=features), "cells", "doc_id")
    n, first = df.count(), df.select(features).first()
    if first is None:
        return df.drop(features).withColumns({f"pc{i + 1}": F.lit(0.0) for i in range(k)}), [0.0] * k
    size = first[0].size
    if size > MAX_TERMS_ON_DRIVER:
        raise ValueError(f"more than {MAX_TERMS_ON_DRIVER} features")
    sums = cells.groupBy("i").agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("q")).toPandas()
    mean = np.zeros(size)
    mean[sums["i"].to_numpy(dtype=int)] = sums["s"].to_numpy() / n
    total = sums["q"].sum() / n - float(mean @ mean)

    block = np.linalg.qr(np.random.default_rng(42).normal(size=(size, min(size, k + 6))))[0]
    basis, images = np.zeros((size, 0)), np.zeros((size, 0))
    for _ in range(passes):
        image = _gram_product(cells, block) / n - np.outer(mean, mean @ block)
        basis, images = np.hstack((basis, block)), np.hstack((images, image))
        small = basis.T @ images
        values, turns = np.linalg.eigh((small + small.T) / 2)
        values, turns = values[::-1][:k], turns[:, ::-1][:, :k]
        axes = basis @ turns
        residual = np.linalg.norm(images @ turns - axes * values, axis=0).max()
        room = min(block.shape[1], size - basis.shape[1])
        if residual <= tolerance * max(float(values[0]), 1e-300) or room <= 0:
            break
        rest = image
        for _ in range(2):
            rest = rest - basis @ (basis.T @ rest)
        block = np.linalg.qr(rest)[0][:, :room]
    if axes.shape[1] < k:
        axes = np.hstack((axes, np.zeros((size, k - axes.shape[1]))))
        values = np.concatenate((values, np.zeros(k - len(values))))
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), range(k)] < 0, -1.0, 1.0)

    spark, names = df.sparkSession, [f"pc{i + 1}" for i in range(k)]
    side = spark.createDataFrame(pd.DataFrame(axes, columns=names).rename_axis("i").reset_index())
    shift = mean @ axes
    scores = cells.join(broadcast_if_bounded(side, len(axes)), "i").groupBy("doc_id").agg(
        *[F.sum(F.col("value") * F.col(c)).alias(c) for c in names])
    out = df.drop(features).join(scores, "doc_id", "left").withColumns(
        {c: F.coalesce(c, F.lit(0.0)) - float(shift[i]) for i, c in enumerate(names)})
    return out, [float(v / total) if total > 0 else 0.0 for v in values]


def monomials(cols: Sequence[str], degree: int) -> dict[str, Column]:
    """All products of 1…degree columns, without a constant."""
    out = {}
    for d in range(1, degree + 1):
        for combo in combinations_with_replacement(cols, d):
            out["_".join(combo)] = reduce(mul, [F.col(c) for c in combo])
    return out


def poly_expand(df: DataFrame, cols: Sequence[str], degree: int) -> DataFrame:
    return df.withColumns({n: c for n, c in monomials(cols, degree).items() if n not in cols})


def poly_feature_count(n: Column, degree: int) -> Column:
    """C(n + d, d) − 1, by integer steps that never leave a remainder."""
    count = F.lit(1).cast("long")
    for i in range(1, degree + 1):
        count = ((count * (n + i)) / F.lit(i)).cast("long") if i == 1 else \
            F.floor((count * (n + i)) / F.lit(i)).cast("long")
    return count - 1


def _assembled(df: DataFrame, degree: int) -> DataFrame:
    names = list(monomials(["pc1", "pc2"], degree))
    return VectorAssembler(inputCols=names, outputCol="features").transform(
        poly_expand(df, ["pc1", "pc2"], degree))


def poly_lr_sweep(points: DataFrame, degrees: Sequence[int] = (1, 2, 3),
                  classes: Sequence[str] = CLASSES) -> DataFrame:
    """Train and test accuracy, weighted F1 and width per degree.

    `points` is (label, is_test, pc1, pc2)."""
    points = materialize(points.select("label", "is_test", "pc1", "pc2"), "points")
    runs = []
    for degree in degrees:
        rows = _assembled(points, degree)
        model = lr_fit(rows.filter(~F.col("is_test")), "l2", classes=classes)
        runs.append(lr_score(model, rows, classes).select(
            F.lit(degree).alias("degree"), F.lit(model.numFeatures).alias("n_features"),
            "is_test", "label", "prediction"))
    by = ["degree", "n_features"]
    table = weighted_prf(reduce(DataFrame.unionByName, runs), [*by, "is_test"])
    return table.groupBy(*by).agg(
        F.max(F.when(~F.col("is_test"), F.col("accuracy"))).alias("train_accuracy"),
        F.max(F.when(F.col("is_test"), F.col("accuracy"))).alias("test_accuracy"),
        F.max(F.when(F.col("is_test"), F.col("f1"))).alias("f1"))


def decision_grid(points: DataFrame, degree: int = 2, steps: int = 200, margin: float = 0.5,
                  classes: Sequence[str] = CLASSES) -> DataFrame:
    """Predicted class on a steps × steps grid spanning the data ± margin."""
    points = materialize(points.select("label", "is_test", "pc1", "pc2"), "points")
    model = lr_fit(_assembled(points, degree).filter(~F.col("is_test")), "l2", classes=classes)
    box = points.agg(F.struct(*[f(c).alias(f"{n}_{c}") for c in ("pc1", "pc2")
                                for n, f in (("lo", F.min), ("hi", F.max))]).alias("b")).scalar()
    spark: SparkSession = points.sparkSession
    grid = spark.range(steps * steps).withColumn("b", box)

    def axis(c: str, step: Column) -> Column:
        low, high = F.col(f"b.lo_{c}") - margin, F.col(f"b.hi_{c}") + margin
        return low + (high - low) * step / (steps - 1)

    cells = grid.select(F.col("id").alias("cell"),
                        axis("pc1", F.col("id") % steps).alias("pc1"),
                        axis("pc2", F.floor(F.col("id") / steps)).alias("pc2"))
    return lr_score(model, _assembled(cells, degree), classes).select("cell", "pc1", "pc2", "prediction")


def minmax_scale(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Scale columns to [0, 1]; a constant column becomes 0.5.  The extremes
    are one scalar subquery; the rows are not shuffled."""
    box = df.agg(F.struct(*[f(c).cast("double").alias(f"{n}_{c}") for c in cols
                            for n, f in (("lo", F.min), ("hi", F.max))]).alias("b")).scalar()
    out = df.withColumn("__b", box)
    for c in cols:
        low, high = F.col(f"__b.lo_{c}"), F.col(f"__b.hi_{c}")
        out = out.withColumn(c, F.when(high > low, (F.col(c) - low) / (high - low)).otherwise(F.lit(0.5)))
    return out.drop("__b")
