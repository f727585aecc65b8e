"""Counts kept by signed changes, and mergeable sketches."""

import pytest
from pyspark.sql import functions as F

from lexmill.operators import bayes as NB, bow as B, ngrams as L, running as C, sketches as S, tfidf as TF

SCHEMA = "doc_id long, label string, tokens array<string>, sign int"
OLD = [(1, "Real", ["a", "b", "a"]), (2, "Fake", ["b"]), (3, "Real", ["c", "c"]), (4, "Satire", [])]
NEW = [(2, "Real", ["b", "d"]), (5, "Fake", ["a", "d", "d"]), (6, "Fake", None)]


def signed(spark, rows, sign=1):
    return spark.createDataFrame([(*r, sign) for r in rows], SCHEMA)


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_refreshed_state_equals_a_recount(spark, tmp_path):
    base = str(tmp_path)
    C.refresh(spark, base, "counts", "v1", signed(spark, OLD))
    change = signed(spark, [OLD[1], OLD[2]], -1).union(signed(spark, NEW))       # 2 revised, 3 withdrawn
    state = C.refresh(spark, base, "counts", "v2", change, since="v1")
    kept = [OLD[0], OLD[3], *NEW]
    whole = C.refresh(spark, base, "counts", "whole", signed(spark, kept))
    assert sorted_rows(state) == sorted_rows(whole)
    assert "c" not in {r.word for r in state.collect()}

    docs = signed(spark, [(i, y, t or []) for i, y, t in kept])
    tf = B.term_counts(docs, carry=("label",))
    assert sorted_rows(C.vocabulary_of(state)) == sorted_rows(TF.fit_tfidf(tf, B.document_count(docs)))
    assert sorted_rows(C.ngrams_of(state)) == sorted_rows(L.ngram_counts(docs, 2))
    assert sorted_rows(NB.nb_fit(NB.class_sums(C.terms_of(state)))) == sorted_rows(NB.nb_fit(NB.class_sums(tf)))


def test_a_refresh_counts_once(spark, tmp_path):
    base = str(tmp_path)
    C.refresh(spark, base, "counts", "v1", signed(spark, OLD))
    with pytest.raises(FileExistsError):
        C.refresh(spark, base, "counts", "v1", signed(spark, OLD))
    with pytest.raises(Exception, match="never counted"):
        C.refresh(spark, base, "counts", "v2", signed(spark, [(9, "Real", ["zz"])], -1), since="v1")
    empty = C.refresh(spark, base, "counts", "v3", signed(spark, OLD, -1), since="v1")
    assert empty.count() == 0 and C.vocabulary_of(empty).count() == 0


def test_merged_sketches(spark):
    rows = spark.range(40_000).select(
        (F.col("id") % 8).alias("day"), (F.col("id") % 5_000).alias("who"), (F.col("id") * 7919 % 40_000).alias("v"))
    daily = S.sketched(rows, ["day"], "who", "v")
    whole = S.estimates(S.merged(daily)).first()
    halves = S.merged(daily.withColumn("half", F.col("day") % 2), ["half"])
    assert whole.n == 40_000 and S.estimates(S.merged(halves)).first().n_distinct == whole.n_distinct
    assert abs(whole.n_distinct - 5_000) <= S.DISTINCT_ERROR * 5_000
    assert abs(whole.p50 - 20_000) <= S.RANK_ERROR * 40_000 and abs(whole.p95 - 38_000) <= S.RANK_ERROR * 40_000


def test_sketches_without_values(spark):
    rows = spark.createDataFrame([(1, None, None)], "day int, who string, v double")
    r = S.estimates(S.sketched(rows, ["day"], "who", "v"), ["day"]).first()
    assert (r.n, r.n_distinct, r.p50) == (1, 0, None)
    assert S.estimates(S.merged(S.sketched(rows.limit(0), ["day"], "who", "v"), ["day"]), ["day"]).count() == 0
