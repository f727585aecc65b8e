import hashlib
import json

import pytest
from pyspark.sql import functions as F

from lexmill.operators import corpus as D, experiments as R, scoring as G
from lexmill.sources import lake, readers, runs


def test_statements(spark, tmp_path):
    good = "\t".join(["1.json", "half-true", "A claim", "s", "sp", "j", "st", "p", "1", "2", "3", "4", "5", "ctx"])
    (tmp_path / "a.tsv").write_text(good + "\n" + good.replace("half-true", "pants-fire") + "\n")
    (tmp_path / "b.tsv").write_text(good.replace("half-true", "unknown") + "\n" + good.replace("\t3\t", "\tx\t") + "\n"
                                    + good.replace("half-true", "false") + "\tone\tmore\n"
                                    + "9.json\tbarely-true\tShort line\n")
    df = readers.read_statements_tsv(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv")])
    mapped = D.drop_missing(D.map_labels(df), ["mapped_label", "statement"])
    rows = D.conform(mapped, "statements", "statement", "mapped_label", "label")
    assert sorted((r.label, r.original_label) for r in rows.collect()) == [
        ("Fake", "barely-true"), ("Fake", "pants-fire"), ("Real", "half-true"), ("Real", "half-true")]


def test_titles_and_headlines(spark, tmp_path):
    (tmp_path / "fake.csv").write_text('id,title\n1,"A, quoted ""title"""\n2,\n5,x,y\n')
    (tmp_path / "real.csv").write_text("id,title,extra\n3,Plain,z\n")
    df = readers.read_titles_csv(spark, {str(tmp_path / "fake.csv"): "Fake", str(tmp_path / "real.csv"): "Real"})
    rows = D.conform(D.drop_missing(df, ["title"]), "titles", "title", "label").collect()
    assert sorted((r.text, r.label) for r in rows) == [('A, quoted "title"', "Fake"), ("Plain", "Real")]
    (tmp_path / "h.json").write_text(json.dumps([{"headline": "x", "is_sarcastic": 1}, {"headline": "y", "is_sarcastic": 0}]))
    kept = D.keep_flagged(readers.read_headlines_json(spark, str(tmp_path / "h.json"))).collect()
    assert [(r.headline, r.label) for r in kept] == [("x", "Satire")]


def test_corpus_and_manifest(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", ok', "Real")], "doc_id long, text string, label string")
    lake.write_corpus(df, str(tmp_path / "c"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "c/csv")).first()
    assert back.text == 'say "hi", ok' and spark.read.parquet(str(tmp_path / "c/parquet")).count() == 1
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/a.txt").write_bytes(b"hello")
    row = lake.raw_manifest(spark, str(tmp_path / "raw"), source="test").first()
    assert (row.original_filename, row.file_size_bytes, row.md5_hash, row.source) == \
        ("a.txt", 5, hashlib.md5(b"hello").hexdigest(), "test")


def test_versions(spark, tmp_path):
    base = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        lake.read_version(spark, base, "processed", "d")
    for v in ("v2", "v10"):
        lake.write_version(spark.createDataFrame([(v,)], "v string"), base, "processed", "d", v)
    (tmp_path / "processed/_temp").mkdir()
    assert lake.list_versions(spark, base) == ["v10", "v2"]
    assert lake.read_version(spark, base, "processed", "d").first().v == "v2"
    assert lake.read_version(spark, base, "processed", "d", natural=True).first().v == "v10"
    with pytest.raises(FileNotFoundError):
        lake.read_version(spark, base, "processed", "d", "v3")
    words = spark.createDataFrame([("a", [1.0])], "word string, vector array<double>")
    lake.write_word_vectors(words, base, "v1")
    lake.save_model_tables(base, "v2", {"words": words})
    assert lake.load_model_tables(spark, base, "v2", ["words"])["words"].first().word == "a"


def test_runs(spark, tmp_path):
    for i, (stop, norm, acc) in enumerate([("standard", "lemma", .6), ("custom", "stem", .8)]):
        for kind, entries in (("params", {"stopword_list": stop, "normalization_method": norm,
                                          "min_token_length": "1", "max_features": str(5000 * (i + 1))}),
                              ("metrics", {"accuracy": f"1700000000000 0.1 0\n1700000000001 {acc} 1",
                                           "f1_weighted": f"1700000000001 {acc} 0"})):
            folder = tmp_path / "exp" / f"run{i}" / kind
            folder.mkdir(parents=True)
            for k, v in entries.items():
                (folder / k).write_text(v + ("\n" if kind == "metrics" else ""))
    df = runs.read_runs(spark, str(tmp_path))
    got = {r.run_id: r for r in df.collect()}
    assert got["run1"].params["stopword_list"] == "custom" and got["run1"].metrics["accuracy"] == .8
    assert got["run0"].ts == 1700000000001
    table = {r.run_id: r for r in R.compare_runs(df).collect()}
    assert table["run0"].accuracy == 0 and table["run1"].accuracy == 1 and table["run0"].min_token_len == .5
    R.log_run(spark, str(tmp_path / "log"), "r1", {"a": 1}, {"accuracy": 0.5})
    R.log_run(spark, str(tmp_path / "log"), "r2", {"a": 2}, {"accuracy": 0.7})
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2


def test_scorecards(spark, tmp_path):
    cards = {"S1": {"a": {"score": 5, "justification": "x"}, "b": {"score": 3, "justification": "y"}},
             "S2": {"a": {"score": 2, "justification": "z"}}}
    (tmp_path / "cards.json").write_text(json.dumps(cards, indent=2))
    df = runs.read_scorecards(spark, str(tmp_path / "cards.json"))
    assert {r.source: (r.total, r.out_of) for r in runs.scorecard_totals(df).collect()} == {"S1": (8, 25), "S2": (2, 25)}
    runs.write_scorecards(df, str(tmp_path / "out"))
    back = runs.read_scorecards(spark, str(tmp_path / "out"))
    assert back.first().cards["S1"]["b"].score == 3


LOG = """2024-05-01 10:00:00 | INFO | api | REQUEST | POST /classify | Client: 1.2.3.4 | Query: {}
2024-05-01 10:00:01 | INFO | api | RESPONSE | POST /classify | Status: 200 | Time: 10.5ms
2024-05-01 10:00:02 | INFO | api | RESPONSE | POST /classify | Status: 200 | Time: 20.5ms
2024-05-01 10:00:03 | INFO | api | RESPONSE | POST /classify | Status: 422 | Time: 1.0ms
2024-05-01 10:00:04 | ERROR | api | ERROR | POST /retrieve/similar | Error: boom | Time: 3.0ms
noise
"""


def test_request_log(spark, tmp_path):
    (tmp_path / "api.log").write_text(LOG)
    log = readers.read_request_log(spark, str(tmp_path / "api.log"))
    rows = log.orderBy("ts").collect()
    assert len(rows) == 5 and rows[0].client == "1.2.3.4" and rows[1].status == 200 and rows[1].ms == 10.5
    summary = {(r.path, r.status): r for r in G.request_summary(log).collect()}
    assert summary["/classify", 200].n == 2 and summary["/classify", 200].mean_ms == 15.5
    assert summary["/classify", 200].p50_ms == 15.5 and summary["/classify", 422].error_share == 1.0
    assert summary["/retrieve/similar", None].error_share == 1.0


def test_a_version_whose_writer_died_is_never_listed(spark, tmp_path):
    base = str(tmp_path)
    rows = spark.range(100).repartition(4)
    lake.write_version(rows, base, "processed", "d", "v1")
    died = F.udf(lambda i: 1 // (i - 57), "long")
    with pytest.raises(Exception):
        lake.write_version(rows.select(died("id").alias("id")), base, "processed", "d", "v2")
    assert (tmp_path / "processed/v2/d").is_dir()
    assert lake.list_versions(spark, base) == ["v1"]
    assert lake.read_version(spark, base, "processed", "d").count() == 100
    with pytest.raises(FileNotFoundError):
        lake.read_version(spark, base, "processed", "d", "v2")
    (tmp_path / "processed/v3/_commits").mkdir(parents=True)
    (tmp_path / "processed/v3/_commits/d").touch()       # died between creating and writing the record
    assert lake.list_versions(spark, base) == ["v1"]
    lake.write_version(rows.limit(7), base, "processed", "d", "v2")
    assert lake.list_versions(spark, base) == ["v1", "v2"]
    assert lake.read_version(spark, base, "processed", "d").count() == 7


def test_of_two_writers_of_a_version_one_wins(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    pinned = []
    commit = lake._commit

    def late(*given):
        """Another writer commits while this one's data is being written."""
        monkeypatch.setattr(lake, "_commit", commit)
        pinned.append(lake.write_version(spark.range(3), base, "raw", "d", "v1"))
        commit(*given)

    monkeypatch.setattr(lake, "_commit", late)
    with pytest.raises(FileExistsError):
        lake.write_version(spark.range(9), base, "raw", "d", "v1")
    assert lake.read_version(spark, base, "raw", "d", "v1").count() == 3 == spark.read.parquet(pinned[0]).count()
    with pytest.raises(FileExistsError):
        lake.write_version(spark.range(5), base, "raw", "d", "v1")
    lake.write_version(spark.range(5), base, "raw", "other", "v1")
    assert lake.read_version(spark, base, "raw", "d").count() == 3
