"""Toxicity categories by a chain of linear classifiers.

The categories are predicted one after another, and every model sees the
probabilities of the earlier ones beside the words:

    sustained  a toxic text with three or more words that mark toxic texts
    dense      a toxic text in which one word of fifty, or more, is such a mark
    toxic      the label; its model sees the words and both probabilities before

The first two are not labelled; they follow from the label and the words
that stand almost only in texts labelled toxic.  A later model is trained on
out-of-fold probabilities of the earlier categories: each row's probability comes
from a model that has not seen it, so the chain meets the same kind of input in
training as in use.

Features are the words of a text and their first PREFIX letters, each at most
once a text.  Their document counts are grouped in Spark, and the VOCABULARY
features that tell the classes apart best are kept.  All models are fitted by
Spark on a bounded sample of labelled rows (TRAIN_ROWS, chosen by a hash; equal
texts count once, toxic where one copy is; rows with crc32(doc_id as text) mod 5 = 0
are never used).
The out-of-fold probabilities also choose the limit from which a text is called
toxic: the middle of the range of best F1.  Scoring is one pass over whole texts,
without a shuffle.

Cases: null and empty texts have no feature and get the intercepts; labels that
are null or name no document are ignored; a category with one class in training
is predicted constant; repeated rows each get a row; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, functions as F, types as T

from lexmill.llm.shared import materialize

CATEGORIES = ("sustained", "dense", "toxic")      # the decision is on the last
TRAIN_ROWS = 10_000
VOCABULARY = 4_096
FOLDS = 3
PREFIX = 5
LEAST_TEXTS = 4
MARK_SHARE = 0.95           # of the texts with a mark, so many are toxic
PENALTY = 0.0002
ITERATIONS = 20
TASKS = 3                   # the sample is bounded, so are the tasks of a fit
_WORD = re.compile(r"[^\W\d_]+")


def features(text: str) -> tuple[list[str], set[str]]:
    """The words of a text, and its distinct features: words, and prefixes with
    a star."""
    words = _WORD.findall(text.lower())
    found = set(words)
    found.update({w[:PREFIX] + "*" for w in found if len(w) > PREFIX})
    return words, found


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [sorted(features(v.as_py() or "")[1]) for v in batch.column(0)]
        lengths = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for r in rows for x in r], pa.string()),
             batch.column(1).take(pa.array(np.repeat(np.arange(len(rows)), lengths)))],
            names=["feature", "toxic"])


_VECTOR = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"


def _vector_rows(index: dict[str, int], marks: set[str]):
    kind = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())),
                      ("values", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, sustained, dense = [], [], []
            for value, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                words, found = features(value.as_py() or "")
                at = sorted(index[x] for x in found if x in index)
                vectors.append({"type": 0, "size": len(index), "indices": at, "values": [1.0] * len(at)})
                n = sum(w in marks for w in words)
                sustained.append(float(toxic == 1 and n >= 3))
                dense.append(float(toxic == 1 and 50 * n >= len(words) > 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(vectors, kind), pa.array(sustained), pa.array(dense), batch.column(1), batch.column(2)],
                names=["words", *CATEGORIES, "fold"])
    return run


@dataclass
class ToxicityChain:
    """Feature positions, and for each category its intercept, word weights and
    the weights of the earlier probabilities."""

    index: dict[str, int]
    intercepts: list[float]
    weights: np.ndarray             # features x categories
    links: list[list[float]]
    limit: float = 0.5

    def probabilities(self, text: str) -> list[float]:
        at = [self.index[x] for x in features(text)[1] if x in self.index]
        logits = self.weights[at].sum(axis=0) if at else np.zeros(len(self.intercepts))
        out: list[float] = []
        for i, b in enumerate(self.intercepts):
            z = b + float(logits[i]) + sum(w * p for w, p in zip(self.links[i], out))
            out.append(1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, z)))))
        return out


def _fit_one(rows: DataFrame, inputs: list[str], label: str):
    """A fitted model, or the constant probability of a category with one class."""
    classes = [r[0] for r in rows.select(label).distinct().collect()]
    if len(classes) < 2:
        return float(classes[0]) if classes else 0.0
    assembled = VectorAssembler(inputCols=inputs, outputCol="features").transform(rows)
    return LogisticRegression(labelCol=label, regParam=PENALTY, maxIter=ITERATIONS).fit(assembled)


def _with_probability(rows: DataFrame, model, inputs: list[str], name: str) -> DataFrame:
    if isinstance(model, float):
        return rows.withColumn(name, F.lit(model))
    assembled = VectorAssembler(inputCols=inputs, outputCol="features").transform(rows)
    scored = model.transform(assembled).withColumn(name, vector_to_array("probability")[1])
    return scored.select(*rows.columns, name)


def best_limit(rows: DataFrame, label: str, name: str) -> float:
    """The limit of best F1 for the probabilities `name`, in steps of 0.1 %."""
    step = F.floor(F.col(name) * 1000).cast("int")
    bins = {r["step"]: (r["n"], r["k"]) for r in rows.groupBy(step.alias("step")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(label).alias("k")).collect()}
    total = sum(k for _, k in bins.values())
    found, hits, scores = 0, 0.0, []
    for at in range(1000, 0, -1):
        n, k = bins.get(at, (0, 0.0))
        found, hits = found + n, hits + k
        scores.append((2 * hits / max(1.0, found + total), at))
    top = max(f for f, _ in scores)
    best = [at for f, at in scores if f == top]
    return (max(best) + min(best)) / 2000


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> ToxicityChain:
    """Learn the chain from `labels.toxic`."""
    known = (labels.filter(F.col("toxic").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
             .groupBy("doc_id").agg(F.max("toxic").cast("double").alias("toxic")))
    share = int((1 << 30) * min(1.0, rows / max(1, known.count())))
    known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share)
    texts = docs.select("doc_id", "text").join(known, "doc_id").withColumn("same", F.xxhash64("text"))
    texts = texts.groupBy("same", "text").agg(F.max("toxic").alias("toxic"))
    texts = materialize(texts.select("text", "toxic", F.pmod("same", F.lit(FOLDS)).cast("int").alias("fold")), "labelled")
    n, positive = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0.0))).first()
    p = positive / n if n else 0.0
    if not 0 < p < 1:
        return ToxicityChain({}, [-60.0] * 2 + [60.0 if p else -60.0], np.zeros((0, 3)), [[], [0.0], [0.0, 0.0]])

    counted = (texts.select("text", "toxic").mapInArrow(_feature_rows, "feature string, toxic double")
               .groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("k"))
               .filter(F.col("n") >= LEAST_TEXTS))
    apart = F.abs(F.col("k") - F.col("n") * p) / F.sqrt(F.col("n") * p * (1 - p))
    chosen = counted.orderBy(apart.desc(), "feature").limit(VOCABULARY).collect()
    index = {r["feature"]: i for i, r in enumerate(chosen)}
    marks = {r["feature"] for r in chosen if r["k"] >= MARK_SHARE * r["n"] and not r["feature"].endswith("*")}

    ddl = f"words {_VECTOR}, {', '.join(f'{c} double' for c in CATEGORIES)}, fold int"
    stored = T.StructType([T.StructField("words", VectorUDT()), *[T.StructField(c, T.DoubleType()) for c in CATEGORIES],
                           T.StructField("fold", T.IntegerType())])
    train = materialize(texts.mapInArrow(_vector_rows(index, marks), ddl), "vectors", schema=stored)
    train = train.coalesce(TASKS)
    inputs, models = ["words"], []
    for category in CATEGORIES:
        models.append(_fit_one(train, inputs, category))
        name, parts = f"p_{category}", None
        for fold in range(FOLDS):
            model = _fit_one(train.filter(F.col("fold") != fold), inputs, category)
            part = _with_probability(train.filter(F.col("fold") == fold), model, inputs, name)
            parts = part if parts is None else parts.union(part)
        train = materialize(parts, "folds").coalesce(TASKS)
        inputs = [*inputs, name]
    limit = best_limit(train, CATEGORIES[-1], inputs[-1])

    weights, intercepts, links = np.zeros((len(index), len(CATEGORIES))), [], []
    for i, model in enumerate(models):
        if isinstance(model, float):
            intercepts.append(60.0 if model else -60.0)
            links.append([0.0] * i)
            continue
        w = model.coefficients.toArray()
        weights[:, i] = w[:len(index)]
        links.append([float(x) for x in w[len(index):]])
        intercepts.append(float(model.intercept))
    return ToxicityChain(index, intercepts, weights, links, limit)


def scored(docs: DataFrame, chain: ToxicityChain) -> DataFrame:
    """(doc_id, p_sustained, p_dense, p_toxic, toxic) of every row of `docs`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = [chain.probabilities(v.as_py() or "") for v in batch.column(1)]
            columns = [pa.array([r[i] for r in p], pa.float64()) for i in range(len(CATEGORIES))]
            flag = pa.array([int(r[-1] >= chain.limit) for r in p], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, flag],
                                             names=["doc_id", *[f"p_{c}" for c in CATEGORIES], "toxic"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = ", ".join(f"p_{c} double" for c in CATEGORIES)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {ddl}, toxic int")
