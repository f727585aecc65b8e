"""Exact decisions, bounds that are gone, and mended sources."""

from collections import Counter

import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lexmill.operators import (bayes as NB, corpus as D, dimensions as X, embeddings as E, metrics as M,
                               ngrams as L, retrieval as R, scoring as G)
from lexmill.plans import tables
from lexmill.session import drop_materialized, materialize
from lexmill.sources import lake, runs


def rank_auc(rows, c):
    pos = [p for y, p in rows if y == c]
    neg = [p for y, p in rows if y != c]
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))


def test_auc_tells_close_scores_apart(spark):
    rng = random.Random(1)
    rows = [(rng.choice("AB"), 0.5 + rng.randrange(-50, 50) * 1e-9) for _ in range(300)]
    rows += [(rng.choice("AB"), rng.randrange(60) * 1e-14) for _ in range(200)]
    df = spark.createDataFrame([(y, p, 1 - p) for y, p in rows], "label string, p_A double, p_B double")
    got = {r["class"]: r.auc for r in M.auc_ovr(df, ["A", "B"]).collect()}
    assert got["A"] == pytest.approx(rank_auc(rows, "A"), abs=1e-12)
    points = M.roc_points(df, ["A"]).collect()
    assert len(points) == len({p for _, p in rows})
    for r in points:
        above = [y for y, p in rows if p >= r.threshold]
        assert r.tpr == pytest.approx(above.count("A") / sum(y == "A" for y, _ in rows))
        assert r.fpr == pytest.approx(above.count("B") / sum(y == "B" for y, _ in rows))


def test_similar_docs_rank_on_full_values(spark):
    corpus = spark.createDataFrame([(i, "x", "t", 0.5 + i * 1e-8) for i in range(20)],
                                   "doc_id long, label string, term string, w double")
    queries = spark.createDataFrame([(1, "t", 1.0)], "query_id long, term string, w double")
    top = R.similar_docs(queries, corpus, 3, exclude_self=False).orderBy("rank").collect()
    assert [r.doc_id for r in top] == [19, 18, 17]
    tiny = R.similar_docs(queries, corpus.withColumn("w", F.col("w") * 1e-9), 1, exclude_self=False)
    assert tiny.count() == 1


def test_close_perplexities_decide(spark):
    scores = spark.createDataFrame([(1, 2.0 + 1e-9, 2.0), (2, 2.0, 2.0)], "doc_id long, pp_Real double, pp_Fake double")
    got = {r.doc_id: r.prediction for r in L.classify_by_perplexity(scores).collect()}
    assert got == {1: "Fake", 2: "Real"}


def test_close_log_scores_decide(spark):
    rows = spark.createDataFrame([(1, -5.0, -5.0 + 1e-9)], "doc_id long, lp_A double, lp_B double")
    assert NB.nb_predict(rows, ["A", "B"]).first().prediction == "B"


def test_thousands_of_classes(spark):
    df = spark.range(10_000).select(F.col("id").alias("doc_id"), (F.col("id") % 5000).cast("string").alias("label"))
    assert D.balance(df, "class_weighted").filter("sample_weight = 1").count() == 10_000
    skewed = df.withColumn("label", F.when(F.col("doc_id") < 6000, "big").otherwise(F.col("label")))
    weights = D.balance(skewed, "class_weighted").filter("label = 'big'").select("sample_weight").distinct().collect()
    assert [r[0] for r in weights] == [pytest.approx(10_000 / (4001 * 6000))]
    assert D.encode_labels(df).agg(F.max("label_idx")).first()[0] == 4999
    assert D.class_distribution(df).count() == 5000
    assert D.cap_per_group(df, ["label"], 1).count() == 5000
    assert D.sample_n(df, 7000).count() == 7000 and D.sample_n(df, 20_000).count() == 10_000


def test_thousands_of_terms(spark):
    vectors = spark.range(5000).select(F.col("id").alias("word"), F.array(
        F.cos(F.col("id") / 5000), F.sin(F.col("id") / 5000)).alias("vector"))
    small = vectors.filter("word < 60")
    near = E.nearest_words(small, small.select("word"), 2, block=25)
    got = {(r.term, r.neighbor) for r in near.collect()}
    assert near.count() == 120 and {(0, 1), (0, 2), (59, 58), (59, 57)} <= got
    assert E.nearest_words(vectors.filter("word < 3"), vectors.select("word"), 1).count() == 3
    assert E.nearest_words(small, vectors.filter("word > 100").select("word"), 2).count() == 0


def test_lake_under_a_path_that_names_a_layer(spark, tmp_path):
    base = str(tmp_path / "processed" / "lakeA")
    df = spark.createDataFrame([(1,)], "v int")
    lake.write_version(df, base, "processed", "d", "v1")
    assert lake.list_versions(spark, base) == ["v1"]
    assert lake.read_version(spark, base, "processed", "d").first().v == 1
    assert lake.list_versions(spark, str(tmp_path / "none")) == []


def test_runs_with_parameters_of_several_lines(spark, tmp_path):
    for key, value in {"params/a": "one\ntwo", "params/b": "x", "metrics/m": "1 0.5 0\n2 0.7 1\n"}.items():
        path = tmp_path / "exp" / "r1" / key
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(value)
    row = runs.read_runs(spark, str(tmp_path)).first()
    assert row.params == {"a": "one\ntwo", "b": "x"} and row.metrics == {"m": 0.7} and row.ts == 2


def test_batches_whose_ids_hold_dashes(spark, monkeypatch):
    def fake(texts, model, key="doc_id"):
        return texts.select("doc_id", F.lit("Real").alias("prediction"), F.lit(1.0).alias("confidence"))
    monkeypatch.setattr(G, "score_texts", fake)
    model = type("Model", (), {"classes": ("Real",)})()
    rows = [("a-1", "2", "long enough text"), ("a", "1-2", "another long text"), ("a", "3", "one more long text")]
    out = G.score_batches(spark.createDataFrame(rows, "batch_id string, idx string, text string"), model)
    assert {r.batch_id: r.total_texts for r in out.collect()} == {"a-1": 1, "a": 2}


def test_prepared_table_follows_its_input(spark, tmp_path):
    def write(text):
        spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string").write.mode(
            "overwrite").parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    write("first text of the document")
    first = tables.prepared_documents(spark, str(tmp_path))
    assert tables.prepared_documents(spark, str(tmp_path)) is first
    write("second text of the document")
    assert "second" in tables.prepared_documents(spark, str(tmp_path)).first().text_clean


def test_materialized_tables_can_be_dropped(spark):
    kept, gone = materialize(spark.range(3), "kept"), materialize(spark.range(3), "gone", "id")
    assert gone.count() == 3
    assert drop_materialized(spark, keep=("kept", "prepared")) >= 1
    assert kept.count() == 3
    with pytest.raises(Exception):
        spark.table([n for n in gone.inputFiles()][0]).count()


def test_assembly(spark):
    def part(source, rows):
        return spark.createDataFrame([(k, t, y, source, y) for k, t, y in rows],
                                     "key long, text string, label string, source string, original_label string")
    a = part("a", [(i, f"text {i}", "Real") for i in range(10)] + [(10, "text 0", "Real"), (11, None, "Real")])
    b = part("b", [(0, "text 3", "Fake"), (1, "other", None), (2, "new", "Fake")])
    out = D.assemble_corpus({"a": a, "b": b}, {("a", "Real"): 11}).collect()
    assert sorted(r.text for r in out) == sorted([f"text {i}" for i in range(10)] + ["new"])
    assert {r.doc_id for r in out if r.text in ("text 0", "text 3")} == {0, 1}
    assert len({r.doc_id for r in out}) == 11 and all(r.sample_weight > 0 for r in out)


def test_assembly_caps_each_label_of_a_source(spark):
    rows = [(k, f"text {k}", ("Real", "Fake")[k % 4 == 0], "a", "x") for k in range(40)]
    part = spark.createDataFrame(rows, "key long, text string, label string, source string, original_label string")
    out = D.assemble_corpus({"a": part}, {("a", "Real"): 7, ("a", "Fake"): 20}).collect()
    assert Counter(r.label for r in out) == {"Real": 7, "Fake": 10}


def test_principal_components_equal_the_dense_ones(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(80, 30)) * (rng.random((80, 30)) < 0.3)
    rows = [(i, Vectors.sparse(30, {int(j): float(v) for j, v in enumerate(r) if v})) for i, r in enumerate(x)]
    got, ratios = X.pca2(spark.createDataFrame(rows, ["doc_id", "features"]))
    points = {r.doc_id: (r.pc1, r.pc2) for r in got.collect()}
    centred = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred)
    want = centred @ axes[:, ::-1][:, :2]
    for j in range(2):
        mine = np.array([points[i][j] for i in range(80)])
        assert min(abs(mine - want[:, j]).max(), abs(mine + want[:, j]).max()) < 1e-5
        assert ratios[j] == pytest.approx(values[::-1][j] / values.sum())
