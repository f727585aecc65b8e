import pytest
from pyspark.sql import functions as F

from lexmill.operators import scoring as G
from lexmill.streaming import jobs

GOOD = ["officials confirmed the report on the budget", "shocking secret cure hidden from people",
        "area man declares war on his own couch", "parliament passed the budget report"]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, lab, t) for i, (lab, t) in enumerate(zip(("Real", "Fake", "Satire", "Real"), GOOD))]
    return G.fit_scoring_model(spark.createDataFrame(rows, "doc_id long, label string, text_clean string"), 100)


def texts(spark):
    rows = [(str(i), t) for i, t in enumerate(GOOD + ["short", "zzz qqq www nothing known"])]
    return spark.createDataFrame(rows, "doc_id string, text string")


def key(rows):
    return sorted((r.doc_id, r.prediction, round(r.confidence, 6), str(r.top_features)) for r in rows)


def test_batch_scores(spark, model):
    rows = {r.doc_id: r for r in G.score_texts(texts(spark), model).collect()}
    assert set(rows) == {"0", "1", "2", "3", "5"} and rows["1"].prediction == "Fake"
    assert rows["5"].prediction == "Real" and rows["5"].top_features == []
    assert all(abs(sum(r.class_probabilities.values()) - 1) < 1e-9 and 0 <= r.confidence <= 1 for r in rows.values())
    assert all(len(r.top_features) <= 10 for r in rows.values())


def test_score_batches(spark, model):
    rows = [(1, 0, GOOD[0]), (1, 1, GOOD[1]), (2, 0, "short"), (2, 1, GOOD[0])]
    df = spark.createDataFrame(rows, "batch_id long, idx int, text string")
    got = {r.batch_id: r for r in G.score_batches(df, model).collect()}
    assert got[1].total_texts == 2 and got[1].n_Fake == 1 and got[2].error == "too_short" and got[2].total_texts is None


def test_score_stream_equals_batch(spark, model, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    texts(spark).repartition(2).write.parquet(src)
    stream = spark.readStream.schema("doc_id string, text string").option("maxFilesPerTrigger", 1).parquet(src)
    q = jobs.score_stream(stream, model, out, str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert key(spark.read.parquet(out).collect()) == key(G.score_texts(texts(spark), model).collect())


def run_memory(df, name, tmp_path, mode="append"):
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    q.awaitTermination(120)


def events(spark, folder, stamps):
    for i, batch in enumerate(stamps):
        (spark.createDataFrame(batch, "user_id long, text string, ts string").withColumn("ts", F.to_timestamp("ts"))
         .coalesce(1).write.mode("append").parquet(f"{folder}/f{i}"))
    schema = "user_id long, text string, ts timestamp"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def test_quota_stream(spark, tmp_path):
    stamps = [[(1, "a", f"2024-01-01 00:00:{s:02d}") for s in range(12)],
              [(1, "a", "2024-01-01 00:10:00")], [(4, "d", "2024-01-01 00:10:30")],
              [(1, "late", "2024-01-01 00:00:30"), (2, "b", "2024-01-01 00:20:00")],
              [(3, "c", "2024-01-01 00:40:00")]]
    stream = events(spark, str(tmp_path / "in"), stamps)
    run_memory(jobs.quota_stream(stream, 10), "quota", tmp_path)
    got = sorted((r.user_id, r.n, r.over_limit) for r in spark.table("quota").collect())
    assert got == [(1, 1, 0), (1, 12, 2), (2, 1, 0), (4, 1, 0)]


def test_dedup_stream(spark, tmp_path):
    stamps = [[(1, "a", "2024-01-01 00:00:00"), (1, "a", "2024-01-01 00:00:01")],
              [(2, "a", "2024-01-01 00:01:00"), (2, "b", "2024-01-01 00:01:00")]]
    stream = events(spark, str(tmp_path / "in"), stamps)
    run_memory(jobs.dedup_stream(stream), "dedup", tmp_path)
    assert sorted(r.text for r in spark.table("dedup").collect()) == ["a", "b"]
