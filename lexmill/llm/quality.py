"""Quality scores from a sparse rule ensemble.

Statistics of a text are column expressions.  Shallow trees are grown on a
bounded sample of labelled rows; every path from a root to a node is a rule, a
conjunction of bounds on statistics.  A logistic regression with an absolute
penalty weighs the rules and leaves most of them at zero; those that remain are
compiled into one column expression, so scoring is a single pass over the texts
without a shuffle and without Python.

Labels are learned only from rows whose crc32(doc_id as text) mod 5 is not 0;
TRAIN_ROWS bounds how many (rows are chosen by a hash, so the bound holds up to
chance).  Labels, language, source and ids are no inputs.

Cases: null and empty texts have all statistics zero and get a score like any
text; labels that are null or name no document are ignored; repeated rows each
get a row; where fewer than two classes are labelled every score is the share of
label 1 (1 without labels); extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from lexmill.llm.shared import materialize

TRAIN_ROWS = 20_000
TREES = 16
DEPTH = 3
PENALTY = 0.0005
LIMIT = 0.3

STATISTICS = ("words", "word_length", "upper", "digits", "bars", "symbols", "marks", "distinct",
              "repeats", "line_words", "longest")


def held_out(doc_id: str | Column) -> Column:
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def bind(value: Column, use) -> Column:
    """`use(value)` with `value` computed once, however often `use` names it and
    wherever Catalyst moves the expression."""
    return F.transform(F.array(value), use).getItem(0)


def statistics(text: Column) -> Column:
    """The statistics of a text as one struct."""
    def measure(t: Column, w: Column) -> Column:
        n = F.size(w)
        chars, words = F.greatest(F.length(t), F.lit(1)), F.greatest(n, F.lit(1))

        def share(pattern: str) -> Column:
            return F.regexp_count(t, F.lit(pattern)) / chars

        again = F.size(F.filter(w, lambda x, i: (i > 0) & (x == F.get(w, i - 1))))
        measured = {
            "words": F.log1p(n.cast("double")),
            "word_length": F.length(t) / words,
            "upper": share(r"\p{Lu}"),
            "digits": share("[0-9]"),
            "bars": share(r"[|<>{}\[\]\\^~=_]"),
            "symbols": share("[!#$%&*@+]"),
            "marks": share("[.,;:?]"),
            "distinct": F.size(F.array_distinct(w)) / words,
            "repeats": again / words,
            "line_words": words / (F.regexp_count(t, F.lit("\n")) + 1),
            "longest": F.coalesce(F.array_max(F.transform(w, F.length)), F.lit(0)),
        }
        return F.struct(*[measured[name].cast("double").alias(name) for name in STATISTICS])

    def split(t: Column) -> Column:
        return F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    return bind(F.coalesce(text, F.lit("")), lambda t: bind(split(t), lambda w: measure(t, w)))


def _paths(node, bounds: dict) -> list[dict]:
    """Rules of all nodes below a tree node: {statistic: (over, up to)}."""
    if node.getClass().getSimpleName() != "InternalNode":
        return []
    split = node.split()
    name, cut = STATISTICS[split.featureIndex()], float(split.threshold())
    low, high = bounds.get(name, (None, None))
    left = {**bounds, name: (low, cut if high is None else min(high, cut))}
    right = {**bounds, name: (cut if low is None else max(low, cut), high)}
    return [left, right, *_paths(node.leftChild(), left), *_paths(node.rightChild(), right)]


def condition(rule: dict, at: Column) -> Column:
    """A rule as a column over the struct of statistics."""
    parts = []
    for name, (low, high) in sorted(rule.items()):
        if low is not None:
            parts.append(at.getField(name) > F.lit(low))
        if high is not None:
            parts.append(at.getField(name) <= F.lit(high))
    return reduce(lambda a, b: a & b, parts)


class RuleEnsemble:
    """Weighted rules and an intercept."""

    def __init__(self, intercept: float, rules: list[tuple[dict, float]]):
        self.intercept, self.rules = intercept, rules

    def score(self, text: Column) -> Column:
        """The probability of label 1 as a column."""
        def weigh(at: Column) -> Column:
            total = F.lit(self.intercept)
            for rule, weight in self.rules:
                total = total + F.when(condition(rule, at), F.lit(weight)).otherwise(F.lit(0.0))
            return 1.0 / (1.0 + F.exp(-total))
        return bind(statistics(text), weigh)


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> RuleEnsemble:
    """Learn the rules for `labels.quality`."""
    known = (labels.filter(F.col("quality").isin(0, 1) & ~held_out("doc_id"))
             .groupBy("doc_id").agg(F.max("quality").cast("double").alias("label")))
    total = known.count()
    share = int((1 << 30) * min(1.0, rows / max(1, total)))
    known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share)
    labelled = docs.select("doc_id", "text").join(known, "doc_id")
    # one order of the bounded sample, so that equal input gives the same rules
    train = labelled.select("label", statistics(F.col("text")).alias("at")).repartition(1)
    train = materialize(train.sortWithinPartitions("label", F.xxhash64("at")), "quality").coalesce(1)
    classes = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    if len(classes) < 2:
        return RuleEnsemble(-50.0 if 0.0 in classes else 50.0, [])
    n = sum(classes.values())
    weight = F.when(F.col("label") == 1, n / (2 * classes[1.0])).otherwise(n / (2 * classes[0.0]))
    train = train.withColumn("weight", weight)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=64, seed=42, weightCol="weight",
                                    featureSubsetStrategy="0.5", minInstancesPerNode=5).fit(
        train.select(array_to_vector(F.array(*[F.col("at").getField(s) for s in STATISTICS])).alias("features"), "label", "weight"))
    rules = {repr(sorted(r.items())): r for t in forest.trees for r in _paths(t._call_java("rootNode"), {})}
    rules = [rules[k] for k in sorted(rules)]
    if not rules:
        return RuleEnsemble(0.0, [])
    fires = F.array(*[condition(r, F.col("at")).cast("double") for r in rules])
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=60, weightCol="weight").fit(
        materialize(train.select(array_to_vector(fires).alias("features"), "label", "weight"), "rules").coalesce(1))
    kept = [(r, float(w)) for r, w in zip(rules, lasso.coefficients) if abs(w) > 1e-6]
    return RuleEnsemble(float(lasso.intercept), kept)


def scored(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of `docs`."""
    marked = docs.select("doc_id", held_out("doc_id").alias("held_out"), model.score(F.col("text")).alias("score"))
    return marked.withColumn("predicted", (F.col("score") >= LIMIT).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, model: RuleEnsemble | None = None) -> DataFrame:
    """The rows of `docs` whose score reaches LIMIT, in one pass."""
    model = fit(docs, labels) if model is None else model
    return docs.filter(model.score(F.col("text")) >= LIMIT)
