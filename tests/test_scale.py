"""Work and memory that must not grow faster than the input."""

import math

from pyspark.sql import functions as F

from lexmill.functions import cleaning as C, tokenizers as K
from lexmill.operators import bow as B, embeddings as E, retrieval as RT, tokenizing as T


def plan(df):
    return df._jdf.queryExecution().toString()


def test_texts_without_marks_meet_no_pattern(spark):
    """preprocess, preservation_rate and what starts from cleaned texts."""
    df = spark.createDataFrame([(1, "a <b>c</b> http://x.y @me #t a@b.c !! -- d"), (2, "plain words"),
                                (3, None), (4, 'he said "can\'t" cannot Gonna no')], "doc_id long, text string")
    cleaned = df.select("doc_id", C.clean_text(F.col("text")).alias("c"))
    assert all(f", {m})" in plan(cleaned) for m in ("<", "@", "#", "--"))
    words = {r.doc_id: r.w for r in cleaned.select("doc_id", K.tokenize_contractions(F.col("c")).alias("w")).collect()}
    assert words[2] == ["plain", "words"] and words[3] == []
    assert words[1] == ["a", "c", "!", "—", "d"]
    assert words[4] == ["he", "said", "``", "ca", "n't", "''", "can", "not", "gon", "na", "no"]


def test_plural_rule_unchanged(spark):
    words = ["cats", "dog", "glasses", "ponies", "bus", "as", "boxes", "is", None, "miss", "s", "house"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r.x for r in df.select(K.plural_rule(F.col("w")).alias("x")).collect()]
    assert got == ["cat", "dog", "glass", "pony", "bus", "as", "box", "is", None, "miss", "s", "house"]


DOCS = [(1, "a", ["x", "y", "x"]), (1, "a", ["x", "z"]), (None, "a", ["x"]), (2, "b", []), (3, "b", None),
        (4, "b", ["y", None, "y", None])]


def test_term_counts_hold_no_terms_of_a_task(spark):
    """term_counts, top_terms_per_class: rows of one key count together."""
    docs = spark.createDataFrame(DOCS, "doc_id long, label string, tokens array<string>")
    tf = B.term_counts(docs, carry=("label",), keep_empty=True)
    assert "term" not in "".join(x for x in plan(tf).split("== Physical Plan ==")[-1].split("\n") if "Aggregate" in x)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, tf.collect()), key=key) == sorted(
        [(1, "a", "x", 3), (1, "a", "y", 1), (1, "a", "z", 1), (None, "a", "x", 1), (2, "b", None, 0),
         (3, "b", None, 0), (4, "b", "y", 2), (4, "b", None, 0)], key=key)
    assert B.term_counts(docs).filter("doc_id in (2, 3)").count() == 0


def test_token_stats_hold_no_words_of_a_task(spark):
    docs = spark.createDataFrame([(1, "the cat the dog"), (2, "12 34"), (3, "cat"), (3, "dog")],
                                 "doc_id long, text_clean string")
    stats = T.token_stats(docs, spark.createDataFrame([("cat",)], "word string"), ["whitespace"])
    grouped = [x for x in plan(stats).split("== Physical Plan ==")[-1].split("\n") if "Aggregate(keys" in x]
    assert not any(" w#" in x for x in grouped if "tokenizer#" in x)
    row = stats.collect()[0]
    assert math.isclose(row.avg_oov, (0.75 + 0.0 + 0.5) / 3) and math.isclose(row.avg_tokens, 7 / 3)
    rates = {r.doc_id: r.oov_rate for r in T.oov_rate(
        T.tokenize_corpus(docs, "whitespace"), spark.createDataFrame([("cat",)], "word string")).collect()}
    assert rates == {1: 0.75, 2: 0.0, 3: 0.5}


def test_doc_vectors_broadcast_a_small_table_of_vectors(spark):
    """The estimate of a derived table is large, its written size small."""
    wide = spark.range(3000).withColumn("pad", F.array_repeat(F.lit(0.5), 100))
    vectors = (wide.join(wide.withColumnRenamed("pad", "other"), "id").repartition(2)
               .select(F.concat(F.lit("w"), "id").alias("word"), F.slice("pad", 1, 2).alias("vector")))
    docs = spark.createDataFrame([(1, ["w1", "w2", "no"]), (2, [])], "doc_id long, tokens array<string>")
    out = E.doc_vectors(docs, vectors, 2)
    assert "known_" in plan(out) and "ObjectHashAggregate" not in plan(out)
    assert {r.doc_id: r.doc_vector for r in out.collect()} == {1: [0.5, 0.5], 2: [0.0, 0.0]}


def test_nearest_words_meet_in_a_grid(spark):
    """Zero, missing, short and endless vectors, ties and words with two vectors."""
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float((i * 7 + j * 3) % 5 - 2) for j in range(3)]) for i in range(40)]
    rows += [(100, None), (101, [0.0] * 3), (102, [1.0, None, 2.0]), (103, [nan, 1.0, 1.0]), (104, [inf, 1.0, 0.0]),
             (105, [1.0, 2.0]), (106, []), (107, [1e-200] * 3), (None, [1.0] * 3), (3, [1.0, 0.0, 0.0])]
    vectors = spark.createDataFrame(rows, "word long, vector array<double>")
    near = E.nearest_words(vectors, vectors.select("word"), 4)
    assert "FlatMapCoGroupsInArrow" in plan(near)
    a = vectors.filter("word is not null").selectExpr("word term", "vector tv")
    pairs = a.crossJoin(vectors.selectExpr("word neighbor", "vector nv")).filter("term <> neighbor").select(
        "term", "neighbor", E.cosine(F.col("tv"), F.col("nv")).alias("s"))
    pairs.createOrReplaceTempView("pairs")
    want = spark.sql("""SELECT term, r, neighbor, round(s, 9) s FROM (SELECT *, row_number() OVER (
        PARTITION BY term ORDER BY round(s, 12) DESC, neighbor) r FROM pairs) WHERE r <= 4""").collect()
    got = near.selectExpr("term", "rank r", "neighbor", "round(similarity, 9) s").collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_count_vectors_without_a_limit(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (1, ["c"]), (2, []), (3, ["b", "a"])],
                                 "doc_id long, tokens array<string>")
    vocab, rows = B.count_vectors(docs, max_features=None)
    assert {(r.term, r.idx, r.cf, r.df) for r in vocab.collect()} == {("a", 0, 3, 2), ("b", 1, 2, 2), ("c", 2, 1, 1)}
    assert sorted((r.doc_id, r.features.toArray().tolist()) for r in rows.collect()) == [
        (1, [0, 0, 1]), (1, [2, 1, 0]), (2, [0, 0, 0]), (3, [1, 1, 0])]
    many = spark.range(5000).selectExpr("id doc_id", "array(concat('t', id), concat('u', id % 700)) tokens")
    vocab, rows = B.count_vectors(many, max_features=None)
    assert sorted(r.idx for r in vocab.collect()) == list(range(5700))
    assert rows.first().features.size == 5700
    assert B.count_vectors(many, max_features=10)[0].count() == 10
    assert B.count_vectors(many, max_features=None, min_df=2)[0].count() == 700


def test_similar_docs_write_no_touched_pairs(spark):
    """similar_docs, neighbor_label_agreement: one common term touches every pair."""
    rows = [(i, "x", "all", 0.1) for i in range(300)] + [
        (i, "x", f"t{i // 3}", 0.5 + (i % 7) / 100) for i in range(300)] + [(7, "x", "all", 0.05)]
    corpus = spark.createDataFrame(rows, "doc_id long, label string, term string, w double")
    queries = corpus.filter("doc_id % 20 = 0").selectExpr("doc_id query_id", "term", "w")
    hits = RT.similar_docs(queries, corpus, 3)
    sums = {}
    for q, t, wq in queries.collect():
        for d, _, u, w in rows:
            if t == u and d != q:
                sums[q, d] = sums.get((q, d), 0.0) + wq * w
    want = set()
    for q in {q for q, _ in sums}:
        best = sorted((-round(s, 12), d) for (p, d), s in sums.items() if p == q)[:3]
        want |= {(q, r + 1, d) for r, (_, d) in enumerate(best)}
    assert {(r.query_id, r["rank"], r.doc_id) for r in hits.collect()} == want
    cuts = spark.createDataFrame([(0, "all", 0.1, 0.0, 0.0, 0.0), (0, "t0", 0.5, 0.0, 0.0, 0.0)],
                                 "query_id long, term string, wq double, cut double, hidden double, floor double")
    assert RT._open(cuts, corpus, 3, True).filter("score > 0.2").count() == 2
    assert RT._open(cuts, corpus.filter("doc_id < 3"), 3, True).count() == 2
    assert "FlatMapCoGroupsInArrow" in plan(RT._open(cuts, corpus, 3, True))
