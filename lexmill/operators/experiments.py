"""Preprocessing ablation, experiment tables, promotion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from lexmill.functions.tokenizers import (TOKENIZERS, min_token_length, plural_rule,
                                          remove_stopwords, tokenize_vectorizer)
from lexmill.functions.wordlists import CLASSES, stopwords
from lexmill.operators import bayes as NB, bow as B, logistic as LR, metrics as M
from lexmill.operators.dimensions import minmax_scale
from lexmill.operators.normalizing import distinct_words, normalize_via_vocab, stem_vocab
from lexmill.plans.layout import broadcast_if_bounded
from lexmill.session import materialize

PROMOTION_GAIN = 0.01


@dataclass(frozen=True)
class Config:
    name: str
    stopwords: str
    normalization: str
    min_token_len: int
    max_features: int


# The six configurations compared.
CONFIGS = (
    Config("config_1", "standard", "lemma", 1, 5000),
    Config("config_2", "custom", "lemma", 1, 5000),
    Config("config_3", "custom", "stem", 1, 5000),
    Config("config_4", "custom", "lemma", 3, 5000),
    Config("config_5", "custom", "lemma", 1, 10000),
    Config("config_6", "custom", "lemma", 1, 15000),
)


def model_tokens(tokens: Column, stop: str = "custom", min_len: int = 1,
                 normalize: bool = True) -> Column:
    """Stop words out, short tokens out, lemma rule, then the vectorizer's own
    tokens of the joined text."""
    kept = min_token_length(remove_stopwords(tokens, stopwords(stop)), min_len)
    if normalize:
        kept = F.transform(kept, plural_rule)
    return tokenize_vectorizer(F.array_join(kept, " "))


def config_documents(docs: DataFrame, config: Config) -> DataFrame:
    """(doc_id, label, is_test, tokens) of one configuration."""
    keep = ("doc_id", "label", "is_test")
    if config.normalization == "lemma":
        return docs.select(*keep, model_tokens(F.col("tokens"), config.stopwords,
                                               config.min_token_len).alias("tokens"))
    bare = docs.select(*keep, min_token_length(remove_stopwords(
        F.col("tokens"), stopwords(config.stopwords)), config.min_token_len).alias("tokens"))
    if config.normalization == "stem":
        forms = stem_vocab(distinct_words(bare), "snowball")
        bare = normalize_via_vocab(bare, forms, carry=("label", "is_test"), out="tokens")
    return bare.select(*keep, tokenize_vectorizer(F.array_join("tokens", " ")).alias("tokens"))


def _variant(config: Config) -> str:
    return f"{config.stopwords} {config.normalization} {config.min_token_len}"


def _variants(configs: Sequence[Config]) -> dict[str, tuple[int, list[int]]]:
    """Number and vocabulary sizes of every variant: configurations that differ in
    vocabulary size only are one."""
    names = list(dict.fromkeys(map(_variant, configs)))
    return {v: (i, sorted({c.max_features for c in configs if _variant(c) == v})) for i, v in enumerate(names)}


def _forms(words: DataFrame, configs: Sequence[Config]) -> DataFrame:
    """(word, variant, term, times) of distinct words (word, …), as a written table.

    A configuration treats each token on its own, so its terms are worked out once
    for each distinct word.
    """
    alone = words.select(F.col("word").alias("doc_id"), F.lit("").alias("label"), F.lit(False).alias("is_test"),
                         F.array("word").alias("tokens"))
    known = {_variant(c): c for c in configs}
    forms = [config_documents(alone, known[v]).select(
        F.col("doc_id").alias("word"), F.lit(i).alias("variant"), F.explode("tokens").alias("term"))
        for v, (i, _) in _variants(configs).items()]
    return materialize(reduce(DataFrame.unionByName, forms).groupBy("word", "variant", "term").agg(
        F.count(F.lit(1)).alias("times")), "forms")


def _variant_terms(words: DataFrame, forms: DataFrame, configs: Sequence[Config]) -> DataFrame:
    """(variant, term, rank): the most frequent terms of every variant, ties by term,
    up to its largest vocabulary.  `words` has the counts of the distinct words."""
    totals = materialize(forms.join(words, "word").groupBy("variant", "term").agg(
        F.sum(F.col("times") * F.col("n")).alias("cf")), "totals")
    order = [F.desc("cf"), F.asc("term")]
    tops = [totals.filter(F.col("variant") == i).orderBy(*order).limit(sizes[-1])
            .select("variant", "term", F.row_number().over(W.partitionBy().orderBy(*order)).alias("rank"))
            for i, sizes in _variants(configs).values()]
    return materialize(reduce(DataFrame.unionByName, tops), "terms")


def _variant_weights(counts: DataFrame, configs: Sequence[Config],
                     n_docs: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """Weights (variant, doc_id, label, is_test, rank, raw, norm_<size>…) and terms
    (variant, rank, idx_<size>…), as written tables, of counted documents.

    Terms are numbered by rank, and only those some vocabulary can hold meet the
    documents.  The weight at one size is raw / norm_<size> up to that rank.  A
    document has a row without a rank in each variant.  `n_docs` are the numbers of
    documents by variant.
    """
    carry, variants = ("label", "is_test"), _variants(configs)
    sizes, rows = sorted({c.max_features for c in configs}), sum(v[1][-1] for v in variants.values())
    inside = B.unfolded(counts).withColumnRenamed("term", "word")
    words = materialize(inside.filter(F.col("word").isNotNull()).groupBy("word").agg(F.sum("tf").alias("n")), "alone")
    forms = _forms(words, configs)
    terms = _variant_terms(words, forms, configs)
    known = materialize(forms.join(terms, ["variant", "term"]).groupBy("word").agg(
        F.collect_list(F.struct("variant", "rank", "times")).alias("forms")), "known")
    cells = materialize(
        inside.join(known, "word").select("doc_id", *carry, "tf", F.inline("forms"))
        .groupBy("doc_id", *carry, "variant", "rank").agg(F.sum(F.col("tf") * F.col("times")).alias("tf")),
        "cells", "doc_id")
    n = F.get(F.array(*n_docs), F.col("variant")).cast("double")
    dfs = cells.groupBy("variant", "rank").agg(F.count(F.lit(1)).alias("df"))
    by_term = W.partitionBy("variant").orderBy("term")

    def index(size: int) -> Column:
        held = F.col("rank") <= size
        return F.when(held, F.sum(held.cast("int")).over(by_term) - 1).cast("int").alias(f"idx_{size}")

    vocab = materialize(terms.join(dfs, ["variant", "rank"]).select(
        "variant", "rank", (F.ln((1 + n) / (1 + F.col("df").cast("double"))) + 1).alias("idf"),
        *[index(s) for s in sizes]), "vocab")
    whole = counts.select("doc_id", *carry, F.explode(F.array(*[F.lit(i) for i, _ in variants.values()])).alias("variant"),
                          F.lit(None).cast("int").alias("rank"), F.lit(0).cast("long").alias("tf"))
    idf = broadcast_if_bounded(vocab.select("variant", "rank", "idf"), rows)
    raw = cells.unionByName(whole).join(idf, ["variant", "rank"], "left").withColumn(
        "raw", (1 + F.ln(F.greatest("tf", F.lit(1)))) * F.col("idf"))
    same = W.partitionBy("doc_id", "variant")

    def norm(size: int) -> Column:
        x = F.when(F.col("rank") <= size, F.col("raw"))
        return F.sqrt(F.sum(x * x).over(same)).alias(f"norm_{size}")

    weights = raw.select("variant", "doc_id", *carry, "rank", "raw", *[norm(s) for s in sizes])
    return materialize(weights, "weights", "doc_id"), vocab


def _weight(size: int) -> Column:
    """Weight of a term at one vocabulary size, null beyond it."""
    return F.when(F.col("rank") <= size, F.col("raw") / F.col(f"norm_{size}"))


def _logistic_runs(docs: DataFrame, counts: DataFrame, configs: Sequence[Config],
                   classes: Sequence[str]) -> DataFrame:
    """Test predictions of logistic regression, one fit a configuration, on weights
    worked out for all configurations together."""
    carry, variants = ("label", "is_test"), _variants(configs)
    each, merged = B.document_count(docs), B.document_count(counts)
    stems = {_variant(c): c.normalization == "stem" for c in configs}
    weights, vocab = _variant_weights(counts, configs, [merged if stems[v] else each for v in variants])
    runs = []
    for c in configs:
        i, size = variants[_variant(c)][0], c.max_features
        at = vocab.filter((F.col("variant") == i) & (F.col("rank") <= size)).select(
            "rank", F.col(f"idx_{size}").alias("idx"))
        rows = weights.filter(F.col("variant") == i).select("doc_id", *carry, "rank", _weight(size).alias("w"))
        vectors = LR.sparse_vectors(rows.join(broadcast_if_bounded(at, size), "rank", "left"), size, carry)
        scored = LR.lr_score(LR.lr_fit(vectors.filter(~F.col("is_test")), classes=classes),
                             vectors.filter("is_test"), classes)
        runs.append(scored.select(F.lit(c.name).alias("config_name"), "label", "prediction",
                                  *[f"p_{x}" for x in classes]))
    return reduce(DataFrame.unionByName, runs)


def _bayes_runs(docs: DataFrame, counts: DataFrame, configs: Sequence[Config],
                classes: Sequence[str]) -> DataFrame:
    """Test predictions of Naive Bayes (strength 1) for all configurations together:
    one aggregate of class sums, one join and one pass of scores."""
    variants = _variants(configs)
    rows, _ = _variant_weights(counts, configs, [B.document_count(docs)] * len(variants))
    cells = [(s, c) for s in sorted({c.max_features for c in configs}) for c in classes]
    train = ~F.col("is_test")
    sums = rows.filter(F.col("rank").isNotNull()).groupBy("variant", "rank").agg(*[
        F.coalesce(F.sum(F.when(train & (F.col("label") == c), _weight(s))), F.lit(0.0)).alias(f"s_{s}_{c}")
        for s, c in cells])
    whole = W.partitionBy("variant")

    def log_share(size: int, c: str) -> Column:
        known, mass = F.col("rank") <= size, F.col(f"s_{size}_{c}")
        total = F.sum(mass).over(whole) + F.sum(known.cast("long")).over(whole)
        return F.when(known, F.ln((mass + 1) / total)).alias(f"ll_{size}_{c}")

    params = materialize(sums.select("variant", "rank", *[log_share(s, c) for s, c in cells]), "shares")
    bound = sum(v[1][-1] for v in variants.values())
    scored = (rows.filter("is_test").join(broadcast_if_bounded(params, bound), ["variant", "rank"], "left")
              .groupBy("doc_id", "variant", "label").agg(*[
                  F.coalesce(F.sum(_weight(s) * F.col(f"ll_{s}_{c}")), F.lit(0.0)).alias(f"lp_{s}_{c}")
                  for s, c in cells])
              .withColumn("prior", NB.nb_priors(docs.filter(train), classes)))
    runs = F.filter(F.array(*[F.struct(
        F.lit(x.name).alias("config_name"), F.lit(variants[_variant(x)][0]).alias("of"),
        *[(F.col(f"lp_{x.max_features}_{c}") + F.col(f"prior.{c}")).alias(f"lp_{c}") for c in classes])
        for x in configs]), lambda r: r["of"] == F.col("variant"))
    long = scored.select("label", F.explode(runs).alias("r")).select("label", "r.*")
    return NB.nb_predict(NB.nb_proba(long, classes), classes).select(
        "config_name", "label", "prediction", *[f"p_{c}" for c in classes])


def ablation(docs: DataFrame, configs: Sequence[Config] = CONFIGS, model: str = "logistic",
             classes: Sequence[str] = CLASSES) -> DataFrame:
    """Parameters and metrics of every configuration, one row each.

    `docs` is (doc_id, label, is_test, text_clean).  Texts are tokenized and their
    words counted once, into a written table; terms and weights of all configurations
    are worked out together.  Predictions are written once and read per metric.
    """
    counts = B.counted_documents(docs.select(
        "doc_id", "label", "is_test", TOKENIZERS["contractions"](F.col("text_clean")).alias("tokens")),
        carry=("label", "is_test"), name="ablation")
    run = _logistic_runs if model == "logistic" else _bayes_runs
    runs = run(B.document_rows(counts), counts, configs, classes)
    scores = materialize(runs, "predictions")
    params = docs.sparkSession.createDataFrame(
        [(c.name, c.stopwords, c.normalization, c.min_token_len, c.max_features) for c in configs],
        "config_name string, stopwords string, normalization string, min_token_len int, max_features int")
    return params.join(run_metrics(scores, ["config_name"], classes), "config_name")


def run_metrics(scores: DataFrame, by: Sequence[str], classes: Sequence[str] = CLASSES) -> DataFrame:
    """Accuracy, weighted F1, weighted one-vs-rest AUC, per-class P/R/F1 per run."""
    per_class = M.per_class_prf(scores, by)
    support = F.sum("support")
    table = per_class.groupBy(*by).agg(
        (F.sum("tp") / support).alias("accuracy"),
        (F.sum(F.col("f1") * F.col("support")) / support).alias("f1_weighted"),
        *[F.max(F.when(F.col("class") == c, F.col(m))).alias(f"{m}_{c}")
          for c in classes for m in ("precision", "recall", "f1")])
    return table.join(M.weighted_auc(M.auc_ovr(scores, classes, by), by), list(by))


def log_run(spark: SparkSession, path: str, run_id: str, params: Mapping[str, object],
            metrics: Mapping[str, float]) -> None:
    """Append one run (run_id, params, metrics, ts) to a Parquet table."""
    row = spark.createDataFrame(
        [(run_id, {k: str(v) for k, v in params.items()}, {k: float(v) for k, v in metrics.items()})],
        "run_id string, params map<string,string>, metrics map<string,double>")
    row.withColumn("ts", F.current_timestamp()).coalesce(1).write.mode("append").parquet(path)


def compare_runs(runs: DataFrame) -> DataFrame:
    """Runs as scaled numbers: encoded stop-word list and normal form, minimum
    length, vocabulary limit, accuracy and weighted F1."""
    p, m = (lambda k: F.element_at("params", k)), (lambda k: F.element_at("metrics", k))
    norm = p("normalization_method")
    table = runs.select(
        "run_id",
        F.when(p("stopword_list") == "custom", 1.0).otherwise(0.0).alias("stopwords"),
        F.when(norm == "none", 0.0).when(norm == "stem", 1.0).when(norm == "lemma", 2.0).alias("normalization"),
        p("min_token_length").cast("double").alias("min_token_len"),
        p("max_features").cast("double").alias("max_features"),
        m("accuracy").alias("accuracy"), m("f1_weighted").alias("f1_weighted"))
    return minmax_scale(table, table.columns[1:])


def promote(versions: DataFrame, gain: float = PROMOTION_GAIN) -> DataFrame:
    """Stage of every version: (model, version, f1, stage).

    In version order, a version that beats production by `gain` becomes
    Production and archives the old one; any other stays in Staging.  The rule
    is an ordered fold over the versions of one model, a registry-sized list.
    """
    folded = versions.groupBy("model").agg(
        F.sort_array(F.collect_list(F.struct("version", "f1"))).alias("vs"))
    start = F.struct(F.lit(0.0).alias("best"), F.lit(None).cast("long").alias("holder"),
                     F.array().cast("array<bigint>").alias("winners"))

    def step(acc: Column, v: Column) -> Column:
        wins = v["f1"] >= acc["best"] + gain
        version = v["version"].cast("long")
        return F.struct(F.when(wins, v["f1"]).otherwise(acc["best"]).alias("best"),
                        F.when(wins, version).otherwise(acc["holder"]).alias("holder"),
                        F.when(wins, F.concat(acc["winners"], F.array(version)))
                        .otherwise(acc["winners"]).alias("winners"))

    state = folded.withColumn("s", F.aggregate("vs", start, step))
    stage = (F.when(F.col("v.version") == F.col("s.holder"), "Production")
             .when(F.array_contains("s.winners", F.col("v.version").cast("long")), "Archived")
             .otherwise("Staging"))
    return (state.select("model", "s", F.explode("vs").alias("v"))
            .select("model", F.col("v.version").alias("version"), F.col("v.f1").alias("f1"),
                    stage.alias("stage")))


def production_version(staged: DataFrame) -> DataFrame:
    """Per model: production version and F1, number of versions, history."""
    live = F.col("stage") == "Production"
    return staged.groupBy("model").agg(
        F.max(F.when(live, F.col("version"))).alias("version"),
        F.max(F.when(live, F.col("f1"))).alias("f1"),
        F.count(F.lit(1)).alias("n_versions"),
        F.sort_array(F.collect_list(F.struct("version", "stage"))).alias("history"))


def performance_table(staged: DataFrame, metrics: DataFrame) -> DataFrame:
    """Current model with its metric map and version history.

    `metrics` is (model, metric, value)."""
    maps = metrics.groupBy("model").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("metric", "value")))).alias("metrics"))
    return production_version(staged).join(maps, "model", "left")
