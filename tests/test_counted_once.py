"""Terms that several passes need are counted once, and only known terms move."""

import pytest
from pyspark.sql import functions as F

from lexmill.operators import bow as B, experiments as R, scoring as G, tfidf as TF
from lexmill.plans import catalog_models as CM

DOCS = [(1, "a", ["x", "y", "x"]), (1, "a", ["x", "z"]), (None, "a", ["x"]), (2, "b", []), (3, "b", None),
        (4, "b", ["y", None, "y", None]), (4, "b", ["y", None, "y", None])]
TEXTS = [(1, "Real", "the cats ran and ran past dogs"), (2, "Fake", "dogs barked loudly at running cats"),
         (3, "Satire", "a cat and the running dog"), (4, "Real", "ponies run"), (5, "Fake", "of the and"),
         (6, "Real", "cats cats dog ponies"), (6, "Real", "cats cats dog ponies")]


def plan(df):
    return df._jdf.queryExecution().toString()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("keep_empty", [False, True])
def test_counted_documents_are_term_counts(spark, keep_empty):
    docs = spark.createDataFrame(DOCS, "doc_id long, label string, tokens array<string>")
    counts = B.counted_documents(docs, carry=("label",))
    assert rows(B.unfolded(counts, keep_empty)) == rows(B.term_counts(docs, carry=("label",), keep_empty=keep_empty))
    assert rows(B.document_rows(counts)) == rows(docs.select("doc_id", "label"))
    assert "collect_list" not in plan(B.unfolded(counts))


@pytest.mark.parametrize("kind", ["bayes", "logistic"])
def test_scoring_models_read_texts_once(spark, monkeypatch, kind):
    """score_stream, explain_scores: terms come from a written table."""
    seen, transform = [], TF.transform_tfidf
    monkeypatch.setattr(G.TF, "transform_tfidf", lambda tf, *a, **b: (seen.append(tf), transform(tf, *a, **b))[1])
    G.fit_scoring_model(spark.createDataFrame(TEXTS, "doc_id long, label string, text_clean string"), 100, kind=kind)
    assert len(seen) == 1 and "collect_list" not in plan(seen[0]) and "text_clean" not in plan(seen[0])


def test_split_weights_count_once(spark, monkeypatch, tmp_path):
    """lr_explain_scores, score_texts_logistic: one count, fitted and weighted from it."""
    docs = spark.createDataFrame([(i, TEXTS[i % 7][2], "s") for i in range(30)], "doc_id long, text string, source string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, min(i % 3, 1), int(i % 3 == 2)) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    calls, counted = [], B.counted_documents
    monkeypatch.setattr(CM.B, "counted_documents", lambda *a, **b: (calls.append(1), counted(*a, **b))[1])
    assert "collect_list" not in plan(CM.split_weights(spark, str(tmp_path))[1])
    CM.lr_explain_scores(spark, str(tmp_path))
    assert len(calls) == 2


CONFIGS = (R.Config("one", "standard", "lemma", 1, 2), R.Config("two", "custom", "stem", 1, 3),
           R.Config("three", "custom", "lemma", 1, 2), R.Config("four", "custom", "lemma", 1, 4))


def tokenized(spark):
    docs = spark.createDataFrame([(i, y, i % 3 == 0, t.split()) for i, y, t in TEXTS],
                                 "doc_id long, label string, is_test boolean, tokens array<string>")
    return docs, B.counted_documents(docs, carry=("label", "is_test"))


def test_variant_weights_are_tfidf_of_each_configuration(spark):
    """ablation, ablation_naive_bayes: weights and indexes are those of separate fits."""
    docs, counts = tokenized(spark)
    variants = R._variants(CONFIGS)
    n = [B.document_count(counts if "stem" in v else docs) for v in variants]
    weights, vocab = R._variant_weights(counts, CONFIGS, n)
    for c in CONFIGS:
        own = R.config_documents(docs, c)
        tf = B.term_counts(own)
        apart = TF.tfidf(tf, B.document_count(own), max_features=c.max_features).select("doc_id", "idx", F.round("w", 9))
        i, size = variants[R._variant(c)][0], c.max_features
        at = vocab.filter(F.col("variant") == i).select("rank", F.col(f"idx_{size}").alias("idx"))
        got = weights.filter(F.col("variant") == i).withColumn("w", R._weight(size)).join(at, "rank").filter("idx is not null")
        assert rows(got.select("doc_id", "idx", F.round("w", 9))) == rows(apart)


def test_only_known_terms_meet_documents(spark):
    """ablation_naive_bayes: a row a ranked term, one a document, and no term texts."""
    _, counts = tokenized(spark)
    weights, vocab = R._variant_weights(counts, CONFIGS, [F.lit(7)] * 3)
    assert "term" not in weights.columns
    assert vocab.count() == 2 + 3 + 4
    assert weights.filter("rank is null").count() == 3 * counts.count()
    assert weights.agg(F.max("rank")).first()[0] == 4


def test_logistic_ablation_counts_texts_once(spark, monkeypatch):
    calls, counted = [], B._counted
    monkeypatch.setattr(B, "_counted", lambda *a: (calls.append(1), counted(*a))[1])
    docs = spark.createDataFrame(TEXTS, "doc_id long, label string, text_clean string").withColumn(
        "is_test", F.col("doc_id") % 3 == 0)
    got = R.ablation(docs, CONFIGS)
    assert {r.config_name for r in got.select("config_name").collect()} == {c.name for c in CONFIGS}
    assert len(calls) == 1


def test_scores_need_no_window_and_texts_are_split_where_they_lie(spark):
    """explain_scores: one aggregate a text gives length and scores; no tokens are sorted or moved."""
    docs = spark.createDataFrame(TEXTS, "doc_id long, label string, text_clean string")
    model = G.fit_scoring_model(docs, 100)
    scored = G.score_texts(docs.select("doc_id", F.col("text_clean").alias("text")), model)
    assert "Window" not in plan(scored)
    tokens = docs.select("doc_id", "label", G.text_tokens(F.col("text_clean")).alias("tokens"))
    split = B.term_counts(docs, "text_clean", carry=("label",), keep_empty=True, split=G.text_tokens)
    assert rows(split) == rows(B.term_counts(tokens, carry=("label",), keep_empty=True))
    for r in scored.collect():
        shares = [next(iter(m.values())) for m in r.top_features]
        assert shares == sorted(shares, key=lambda x: -abs(round(x, 12)))
        assert abs(sum(r.class_probabilities.values()) - 1) < 1e-9
