import hashlib
import math

import pytest
from pyspark.sql import functions as F

from lexmill.operators import corpus as D, scoring as G
from lexmill.plans.selection import keep_smallest


def order(ids):
    return sorted(ids, key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())


@pytest.fixture(scope="module")
def skewed(spark):
    """One class holds most rows."""
    label = F.when(F.col("id") % 10 < 7, "Real").when(F.col("id") % 10 < 9, "Fake").otherwise("Satire")
    return spark.range(1003).select(F.col("id").alias("doc_id"), label.alias("label"))


def test_split_sizes_and_rows(skewed):
    rows = D.stratified_split(skewed, 0.2).collect()
    want = {"Real": 141, "Fake": 40, "Satire": 20}
    got = {c: sum(r.is_test for r in rows if r.label == c) for c in want}
    assert sum(got.values()) == math.ceil(0.2 * 1003) and got == want
    for c, n in want.items():
        ids = [r.doc_id for r in rows if r.label == c]
        assert {r.doc_id for r in rows if r.label == c and r.is_test} == set(order(ids)[:n])


def test_split_by_count(skewed):
    assert D.stratified_split(skewed, 100).filter("is_test").count() == 100
    assert D.stratified_split(skewed, 5000).filter("is_test").count() == 1003


def test_undersample_equal_classes(skewed):
    rows = D.balance(skewed, "undersample").groupBy("label").count().collect()
    assert {r["count"] for r in rows} == {100} and len(rows) == 3


def test_weights_average_to_one(skewed):
    rows = D.balance(skewed, "class_weighted")
    assert abs(rows.agg(F.avg("sample_weight")).first()[0] - 1) < 1e-9
    even = skewed.filter("doc_id % 10 in (6, 7, 9)")
    assert {r.sample_weight for r in D.balance(even).select("sample_weight").distinct().collect()} == {1.0}


def test_many_groups_take_the_join_path(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), (F.col("id") % 1500).alias("g"))
    rows = D.cap_per_group(df, ["g"], 2).collect()
    assert len(rows) == 3000
    mine = sorted(r.doc_id for r in rows if r.g == 7)
    assert mine == sorted(order([7, 1507, 3007, 4507])[:2])


def test_cap_mapping_leaves_other_groups_whole(skewed):
    rows = D.cap_per_group(skewed, ["label"], {("Real",): 5}).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in rows} == {"Real": 5, "Fake": 200, "Satire": 100}


def test_sample_holds_the_smallest_hashes(skewed):
    ids = order(r.doc_id for r in skewed.collect())
    for n in (1, 50, 1000):
        assert {r.doc_id for r in D.sample_n(skewed, n).collect()} == set(ids[:n])
    assert D.sample_n(skewed, 10**6).count() == 1003


def test_keep_nothing(skewed):
    none = keep_smallest(skewed, "doc_id", [], lambda s: s.withColumn("target", F.lit(0)))
    assert none.count() == 0


def test_dedup_prefers_priority_then_key(spark):
    df = spark.createDataFrame([(1, "a", 2), (2, "a", 1), (3, "a", 1), (4, "b", 9)], "doc_id long, text string, p int")
    assert sorted(r.doc_id for r in D.dedup_exact(df, "p").collect()) == [2, 4]
    assert sorted(r.doc_id for r in D.dedup_exact(df).collect()) == [1, 4]


def test_duplicate_rate(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "text string")
    assert tuple(D.duplicate_rate(df).first()) == (4, 3, 0.25)
    assert D.duplicate_rate(df.limit(0)).first().rate == 0.0
    assert D.duplicate_rate(df, approximate=True).first().n_distinct == 3


def test_labels(spark):
    df = spark.createDataFrame([("true",), ("pants-fire",), ("half-true",), ("odd",), (None,)], "label string")
    assert [r.mapped_label for r in D.map_labels(df).collect()] == ["Real", "Fake", "Real", None, None]
    coded = D.encode_labels(spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "label string"))
    assert [r.label_idx for r in coded.collect()] == [1, 0, 2, 0]


def test_validate_texts(spark):
    df = spark.createDataFrame([(1, "short"), (2, "x" * 10), (3, "x" * 10000), (4, "x" * 10001)], "doc_id long, text string")
    assert [r.reason for r in D.validate_texts(df).orderBy("doc_id").collect()] == ["too_short", None, None, "too_long"]


def test_validate_batches(spark):
    good = "a text of fair length"
    rows = [(1, i, good) for i in range(3)] + [(2, i, good) for i in range(101)] + \
           [(3, 0, good), (3, 1, "short"), (3, 2, "x" * 10001)]
    df = spark.createDataFrame(rows, "batch_id long, idx int, text string")
    heads = spark.createDataFrame([(1,), (2,), (3,), (4,)], "batch_id long")
    got = {r.batch_id: (r.size, r.first_bad, r.error) for r in D.validate_batches(df, headers=heads).collect()}
    assert got == {1: (3, None, None), 2: (101, None, "batch_too_large"),
                   3: (3, 1, "too_short"), 4: (0, None, "empty_batch")}


def test_quota(spark):
    df = spark.createDataFrame([(1, f"2024-01-01 00:00:{s:02d}") for s in range(12)] + [(1, "2024-01-01 00:01:00")],
                               "user_id long, ts string").withColumn("ts", F.to_timestamp("ts"))
    rows = sorted((r.n, r.over_limit) for r in G.quota_audit(df, G.BATCH_QUOTA).collect())
    assert rows == [(1, 0), (12, 2)]
