import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lexmill.operators import (bayes as NB, bow as B, dimensions as X, embeddings as E,
                               experiments as R, logistic as LR, metrics as M, ngrams as L,
                               retrieval as RT, tfidf as TF)
from lexmill.session import materialize

TEXTS = [(1, "Real", "a b a c".split()), (2, "Fake", "b b d".split()), (3, "Satire", "c d e a".split()),
         (4, "Real", "a c".split()), (5, "Fake", []), (6, "Real", "e e b a".split())]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, label string, tokens array<string>")


def test_tfidf_unit_norm_and_values(docs):
    tf = B.term_counts(docs)
    for variant in TF.VARIANTS:
        rows = TF.tfidf(tf, B.document_count(docs), variant).collect()
        norms = defaultdict(float)
        for r in rows:
            norms[r.doc_id] += r.w ** 2
        assert all(abs(v - 1) < 1e-9 for v in norms.values()) and set(norms) == {1, 2, 3, 4, 6}
    df = Counter(t for _, _, ts in TEXTS for t in set(ts))
    raw = {t: (1 + math.log(c)) * (math.log(7 / (1 + df[t])) + 1) for t, c in Counter(TEXTS[0][2]).items()}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    got = {r.term: r.w for r in rows if r.doc_id == 1}
    assert all(abs(got[t] - raw[t] / norm) < 1e-9 for t in raw)


def test_matrix_counts_empty_documents(docs):
    tf = B.term_counts(docs)
    row = B.matrix_stats(tf, B.vocabulary(tf), B.document_count(docs)).first()
    assert (row.n_docs, row.n_features, row.nnz) == (6, 5, 14)


def brute_lm(train, n, smoothing, mode, tokens):
    counts, contexts, vocab, total = Counter(), Counter(), set(), 0
    left, right = defaultdict(set), defaultdict(set)
    grams = lambda ts: [tuple((["<s>"] * (n - 1) + ts + ["</s>"])[i:i + n]) for i in range(len(ts) + 1)]
    followers = defaultdict(set)
    for ts in train:
        vocab.update(ts)
        total += len(ts)
        for g in grams(ts):
            counts[g] += 1
            contexts[g[:-1]] += 1
            followers[g[:-1]].add(g[-1])
        padded = ["<s>"] * (n - 1) + ts + ["</s>"]
        for a, b in zip(padded, padded[1:]):
            left[b].add(a)
            right[a].add(b)
    size, types = len(vocab) + 2, sum(map(len, left.values()))
    logs = []
    for g in grams(tokens):
        c, ctx = counts[g], contexts[g[:-1]]
        if n == 1:
            p = (c + 1) / (total + size) if smoothing == "laplace" else (c / total if c else 1e-10)
        elif smoothing == "laplace":
            p = (c + 1) / (ctx + size)
        elif smoothing == "none":
            p = c / ctx if c else 1e-10
        else:
            cont = max(len(left[g[-1]]) if g[-1] in left else 0, 1e-10) / types
            fol = 1 if n > 2 and mode == "as_implemented" else len(followers[g[:-1]])
            p = max(cont if not ctx else (max(c - 0.75, 0) + 0.75 * fol * cont) / ctx, 1e-10)
        logs.append(math.log(p))
    return math.exp(-sum(logs) / len(logs))


@pytest.mark.parametrize("n, smoothing, mode", [
    (1, "none", ""), (1, "laplace", ""), (2, "none", ""), (2, "laplace", ""), (2, "kneser_ney", ""),
    (3, "kneser_ney", "as_implemented"), (3, "kneser_ney", "formula")])
def test_perplexity_against_brute_force(spark, docs, n, smoothing, mode):
    model = L.fit_ngram_model(docs, n, smoothing, mode=mode or "as_implemented")
    probe = [(10, "a b c".split()), (11, "z a".split()), (12, [])]
    rows = L.perplexity(spark.createDataFrame(probe, "doc_id long, tokens array<string>"), model).collect()
    train = {c: [t for _, lab, t in TEXTS if lab == c] for c in ("Real", "Fake")}
    for r in rows:
        for c in ("Real", "Fake"):
            want = brute_lm(train[c], n, smoothing, mode, dict(probe)[r.doc_id])
            assert abs(r[f"pp_{c}"] - want) <= 1e-6 * max(1, want)
    assert len(rows) == 3


def test_ngram_totals(docs):
    for n in (1, 2, 3):
        total = L.ngram_counts(docs, n).agg(F.sum("c")).first()[0]
        assert total == sum(len(t) + 1 for _, _, t in TEXTS)


def test_naive_bayes_against_numpy(docs):
    rows = B.term_counts(docs, carry=("label",), keep_empty=True)
    loglik = NB.nb_fit(NB.class_sums(rows), 0.5)
    scored = {r.doc_id: r for r in NB.nb_predict(NB.nb_proba(NB.nb_log_proba(
        rows, loglik, NB.nb_priors(docs), carry=("label",)))).collect()}
    terms = sorted({t for _, _, ts in TEXTS for t in ts})
    x = np.array([[Counter(ts)[t] for t in terms] for _, _, ts in TEXTS])
    y = np.array([lab for _, lab, _ in TEXTS])
    for c in ("Fake", "Real", "Satire"):
        s = x[y == c].sum(0) + 0.5
        want = x @ np.log(s / s.sum()) + np.log((y == c).mean())
        for i, (doc, _, _) in enumerate(TEXTS):
            assert abs(scored[doc][f"lp_{c}"] - want[i]) < 1e-6
    assert set(scored) == {1, 2, 3, 4, 5, 6} and scored[5].prediction == "Real"
    assert all(abs(sum(r[f"p_{c}"] for c in ("Fake", "Real", "Satire")) - 1) < 1e-9 for r in scored.values())


def test_context_pairs(docs):
    rows = E.context_pairs(docs, window=1, min_count=3)
    got = [(r.pos, r.center, r.context) for r in rows.filter("doc_id = 1").orderBy("pos").collect()]
    assert got == [(1, "a", ["b"]), (2, "b", ["a", "a"]), (3, "a", ["b", "c"]), (4, "c", ["a"])]


def test_doc_vectors(spark, docs):
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 2.0])], "word string, vector array<double>")
    got = {r.doc_id: r.doc_vector for r in E.doc_vectors(docs, vectors, 2).collect()}
    assert np.allclose(got[1], [2 / 3, 2 / 3]) and got[5] == [0.0, 0.0] and got[2] == [0.0, 2.0]


def test_word_lookup(spark):
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 1.0]), ("c", [0.0, 1.0])], "word string, vector array<double>")
    pairs = spark.createDataFrame([("a", "b"), ("a", "zz")], "a string, b string")
    got = {(r.a, r.b): r.similarity for r in E.word_similarity(vectors, pairs).collect()}
    assert abs(got["a", "b"] - math.sqrt(0.5)) < 1e-9 and got["a", "zz"] is None
    terms = spark.createDataFrame([("a",), ("zz",)], "term string")
    near = E.nearest_words(vectors, terms, 1).collect()
    assert [(r.term, r.neighbor) for r in near] == [("a", "b")]


def test_similar_docs_against_numpy(docs):
    rows = TF.tfidf(B.term_counts(docs, carry=("label",)), B.document_count(docs), carry=("label",)).cache()
    hits = RT.similar_docs(rows.select(F.col("doc_id").alias("query_id"), "term", "w"), rows, 2).collect()
    vec = defaultdict(dict)
    for r in rows.collect():
        vec[r.doc_id][r.term] = r.w
    for q in vec:
        sims = sorted(((-round(sum(w * vec[d].get(t, 0) for t, w in vec[q].items()), 6), d) for d in vec if d != q))
        want = [(d, -s) for s, d in sims if s < 0][:2]
        got = [(r.doc_id, r.similarity) for r in sorted(hits, key=lambda r: r["rank"]) if r.query_id == q]
        assert [d for d, _ in got] == [d for d, _ in want]


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(120):
        c = i % 3
        x = rng.normal(0, 1, 4) + np.array([c, -c, 0, 0])
        rows.append((i, ("Fake", "Real", "Satire")[c], i % 5 == 0, Vectors.dense(x)))
    return spark.createDataFrame(rows, ["doc_id", "label", "is_test", "features"]).cache()


def test_logistic_optimum(blobs):
    """The penalised gradient vanishes at the fitted L2 coefficients."""
    train = blobs.filter("not is_test")
    model = LR.lr_fit(train, "l2", tol=1e-10)
    data = train.collect()
    x = np.array([r.features.toArray() for r in data])
    y = np.array([["Fake", "Real", "Satire"].index(r.label) for r in data])
    z = x @ model.coefficientMatrix.toArray().T + model.interceptVector.toArray()
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    gradient = (p - np.eye(3)[y]).T @ x + model.coefficientMatrix.toArray()
    assert np.abs(gradient).max() < 1e-2
    sparse = LR.lr_fit(train, "l1", C=0.05)
    assert (sparse.coefficientMatrix.toArray() == 0).sum() > 0


def test_logistic_scores(spark, blobs):
    model = LR.lr_fit(blobs.filter("not is_test"))
    rows = LR.lr_score(model, blobs.filter("is_test")).collect()
    for r in rows:
        p = r.class_probabilities
        assert abs(sum(p.values()) - 1) < 1e-9 and r.confidence == max(p.values()) and p[r.prediction] == r.confidence
    table = LR.lr_variants(blobs).collect()
    assert {r.variant for r in table} == {"l1", "l2", "elasticnet"} and sum(r.best for r in table) == 1
    vocab = spark.createDataFrame([(f"t{i}", i) for i in range(4)], "term string, idx int")
    top = LR.lr_top_features(LR.coefficients(model, vocab), 2).collect()
    assert len(top) == 6 and all((r.coef > 0) == (r.sign == "+") for r in top)


def test_pca_against_numpy(blobs):
    out, ratios = X.pca2(blobs)
    rows = {r.doc_id: (r.pc1, r.pc2) for r in out.collect()}
    data = {r.doc_id: r.features.toArray() for r in blobs.collect()}
    x = np.array([data[i] for i in sorted(data)])
    x = x - x.mean(0)
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    want = np.abs(x @ vt[:2].T)
    got = np.abs(np.array([rows[i] for i in sorted(rows)]))
    assert np.allclose(got, want, atol=1e-6)
    assert np.allclose(ratios, (s ** 2 / (s ** 2).sum())[:2], atol=1e-6)


def test_polynomials(spark, blobs):
    counts = spark.range(1).select(*[X.poly_feature_count(F.lit(10), d).alias(f"d{d}") for d in (1, 2, 3)]).first()
    assert tuple(counts) == (10, 65, 285)
    assert len(X.monomials(["x", "y"], 3)) == 9
    points = X.pca2(blobs)[0]
    sweep = {r.degree: r for r in X.poly_lr_sweep(points).collect()}
    assert [sweep[d].n_features for d in (1, 2, 3)] == [2, 5, 9]
    assert all(0 <= sweep[d].test_accuracy <= 1 for d in sweep)
    grid = X.decision_grid(points, 2, steps=20)
    assert grid.count() == 400 and grid.filter("prediction is null").count() == 0


def test_minmax(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (2.0, 5.0)], "a double, b double")
    assert [tuple(r) for r in X.minmax_scale(df, ["a", "b"]).collect()] == [(0.0, 0.5), (1.0, 0.5), (0.5, 0.5)]


PREDICTIONS = [(1, "Real", "Real", .1, .8, .1), (2, "Real", "Fake", .5, .4, .1), (3, "Fake", "Fake", .6, .3, .1),
               (4, "Fake", "Real", .3, .4, .3), (5, "Real", "Real", .3, .6, .1), (6, "Fake", "Fake", .6, .3, .1)]


@pytest.fixture(scope="module")
def predictions(spark):
    return spark.createDataFrame(PREDICTIONS, "doc_id long, label string, prediction string, "
                                 "p_Fake double, p_Real double, p_Satire double")


def test_metrics(predictions):
    per = {r["class"]: r for r in M.per_class_prf(predictions).collect()}
    assert abs(per["Real"].precision - 2 / 3) < 1e-9 and abs(per["Real"].recall - 2 / 3) < 1e-9
    assert abs(M.weighted_prf(predictions).first().accuracy - 4 / 6) < 1e-9
    cells = {(r.label, r.prediction): r.n for r in M.confusion_matrix(predictions, ("Fake", "Real", "Satire")).collect()}
    assert len(cells) == 9 and cells["Fake", "Real"] == 1 and cells["Satire", "Satire"] == 0
    report = {r["class"]: r for r in M.classification_report(predictions).collect()}
    assert report["macro avg"].support == 6 and "weighted avg" in report


def test_auc(predictions):
    aucs = {r["class"]: r.auc for r in M.auc_ovr(predictions, ("Fake", "Real", "Satire")).collect()}
    pos = [p for _, lab, _, p, _, _ in PREDICTIONS if lab == "Fake"]
    neg = [p for _, lab, _, p, _, _ in PREDICTIONS if lab != "Fake"]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert abs(aucs["Fake"] - want) < 1e-9 and aucs["Satire"] is None
    points = M.roc_points(predictions, ("Fake",)).orderBy("threshold").collect()
    assert points[0].fpr == points[0].tpr == 1.0


def test_error_categories(spark):
    long = "x" * 60
    rows = [(1, "Real", "Fake", "short"), (2, "Satire", "Real", long), (3, "Real", "Satire", long),
            (4, "Real", "Fake", long), (5, "Fake", "Real", long), (6, "Fake", "Fake", long)]
    df = spark.createDataFrame(rows, "doc_id long, label string, prediction string, text_clean string")
    got = [r.category for r in M.categorize_errors(df).orderBy("doc_id").collect()]
    assert got == ["SHORT_TEXT", "SATIRE_CONFUSION", "SATIRE_CONFUSION", "SENSATIONAL_REAL", "FORMAL_FAKE"]
    counts = {r.category: r.n for r in M.error_category_counts(df, 2).collect()}
    assert counts == {"SHORT_TEXT": 1, "SATIRE_CONFUSION": 1}


def test_promotion(spark):
    rows = [("m", 1, 0.60), ("m", 2, 0.605), ("m", 3, 0.62), ("m", 4, 0.70), ("m", 5, 0.10), ("n", 1, 0.005)]
    staged = R.promote(spark.createDataFrame(rows, "model string, version int, f1 double"))
    got = {(r.model, r.version): r.stage for r in staged.collect()}
    assert got == {("m", 1): "Archived", ("m", 2): "Staging", ("m", 3): "Archived", ("m", 4): "Production",
                   ("m", 5): "Staging", ("n", 1): "Staging"}
    live = {r.model: r for r in R.production_version(staged).collect()}
    assert live["m"].version == 4 and live["m"].n_versions == 5 and live["n"].version is None
    metrics = spark.createDataFrame([("m", "f1", 0.7)], "model string, metric string, value double")
    assert {r.model: r.metrics for r in R.performance_table(staged, metrics).collect()}["m"] == {"f1": 0.7}


def test_similar_docs_scores_few_pairs_and_stays_exact(spark):
    """600 documents in 30 topics with a word all of them share: equal to scoring
    all pairs, with under a tenth of them scored in full."""
    rng = np.random.default_rng(5)
    rows = []
    for d in range(600):
        terms = {f"t{d % 30}_{i}": rng.uniform(0.5, 1.5) for i in rng.choice(40, 12, replace=False)}
        terms |= {f"common{i}": rng.uniform(0.05, 0.3) for i in range(4)}
        length = math.sqrt(sum(w * w for w in terms.values()))
        rows += [(d, "x", t, float(w / length)) for t, w in terms.items()]
    rows += [(600, "x", t, w) for d, _, t, w in rows if d == 20]     # a copy of a query
    rows += [(601, "x", "alone", 1.0)]                               # shares nothing
    corpus = materialize(spark.createDataFrame(rows, "doc_id long, label string, term string, w double"), "w")
    queries = corpus.filter("doc_id % 20 = 0 or doc_id = 601").select(
        F.col("doc_id").alias("query_id"), "term", "w")
    vec = defaultdict(dict)
    for d, _, t, w in rows:
        vec[d][t] = w
    got = defaultdict(list)
    for r in RT.similar_docs(queries, corpus, 4).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.doc_id)
    asked = [d for d in vec if d % 20 == 0]
    for q in asked:
        sims = sorted((-round(sum(w * vec[d].get(t, 0) for t, w in vec[q].items()), 12), d) for d in vec if d != q)
        assert got[q] == [d for s, d in sims if s < 0][:4]
    assert got[20][0] == 600 and 601 not in got
    scored, first = RT.candidates(queries.withColumnRenamed("w", "wq"), corpus, 4)
    assert scored.count() + first.count() < 0.1 * len(asked) * len(vec)
    assert RT.similar_docs(queries.limit(0), corpus).count() == 0
    assert RT.similar_docs(queries, corpus.limit(0)).count() == 0
