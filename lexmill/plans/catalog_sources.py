"""Registered queries: readers, sinks, versions, logs, runs, streams.

Each writes a given table to the shared folder in the format of a source, reads
it back through the reader, and returns the rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexmill.functions.wordlists import CLASSES
from lexmill.operators import (bayes as NB, corpus as D, experiments as R, running as C,
                               scoring as G, sketches as S)
from lexmill.plans.catalog import nb_alpha_sweep, nb_params, nb_rows, query, rated
from lexmill.plans.catalog_models import conversations, scoring_model
from lexmill.plans.tables import corpus, prepared_documents, query_texts, table
from lexmill.session import materialize, shared_folder
from lexmill.sources import lake, readers, runs
from lexmill.streaming import jobs


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}_{uuid.uuid4().hex}"


def one_line(text: str = "text"):
    return F.trim(F.regexp_replace(text, r"[\s\p{Z}]+", " "))


# --- corpora -------------------------------------------------------------------

@query
def read_statements_tsv(spark, base):
    rows = rated(spark, base)
    path = new_folder(spark, "statements")
    blank = [F.lit(None).cast("string")] * 5 + [F.lit(1)] * 5
    rows.select(F.col("doc_id").cast("string"), "rating", one_line(), *[c.alias(f"c{i}") for i, c in enumerate(blank)],
                F.lit("x").alias("context")).write.option("sep", "\t").csv(path)
    back = readers.read_statements_tsv(spark, path)
    return back.select(F.col("id").cast("long").alias("doc_id"), "label", F.md5("statement").alias("text_md5"))


@query
def read_titles_csv(spark, base):
    rows, path = corpus(spark, base), new_folder(spark, "titles")
    for label in ("Real", "Fake"):
        (rows.filter(F.col("label") == label).select("doc_id", F.col("text").alias("title"))
         .write.option("header", True).option("escape", '"').csv(f"{path}/{label}"))
    back = readers.read_titles_csv(spark, {f"{path}/{c}": c for c in ("Real", "Fake")})
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "label", F.md5("title").alias("text_md5"))


@query
def read_headlines_json(spark, base):
    """Arrays of about 1,000 objects, one file each."""
    rows, path = corpus(spark, base), new_folder(spark, "headlines")
    files = rows.select(F.expr("doc_id div 1000").alias("file"), F.to_json(F.struct(
        F.col("text").alias("headline"), (F.col("label") == "Fake").cast("int").alias("is_sarcastic"),
        F.col("doc_id").cast("string").alias("article_link"))).alias("o"))
    arrays = files.groupBy("file").agg(F.concat(F.lit("["), F.array_join(F.collect_list("o"), ","), F.lit("]")).alias("a"))
    arrays.write.partitionBy("file").text(path)
    back = readers.read_headlines_json(spark, f"{path}/*")
    return back.select(F.col("article_link").cast("long").alias("doc_id"), "is_sarcastic",
                       F.md5("headline").alias("text_md5"))


@query
def write_corpus(spark, base):
    """Both copies of the labelled corpus, read back and joined."""
    path = new_folder(spark, "corpus")
    lake.write_corpus(corpus(spark, base).select("doc_id", "text", "label"), path)
    a = spark.read.parquet(f"{path}/parquet").select("doc_id", "label", F.md5("text").alias("parquet_md5"))
    b = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(f"{path}/csv")
    return a.join(b.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("csv_md5")), "doc_id")


@query
def assemble_corpus(spark, base):
    """Rated, flagged and labelled documents as three sources of one corpus."""
    rows = table(spark, base, "documents").select("doc_id", "text")
    flags = rows.join(table(spark, base, "labels").select("doc_id", F.col("toxic").alias("is_sarcastic")), "doc_id")
    titles = rows.join(table(spark, base, "labels").filter("toxic = 0").select(
        "doc_id", F.when(F.col("quality") == 1, "Real").otherwise("Fake").alias("label")), "doc_id")
    parts = {"statements": (D.map_labels(rated(spark, base), "rating"), "mapped_label", "rating"),
             "headlines": (D.keep_flagged(flags), "label", "label"),
             "titles": (titles, "label", "label")}
    out = D.assemble_corpus({n: D.conform(df.withColumn("key", F.col("doc_id")), n, "text", label, original, keep=("key",))
                             for n, (df, label, original) in parts.items()})
    return out.select("doc_id", "label", "source", "original_label", "sample_weight")


@query
def raw_manifest(spark, base):
    """A text file for each benchmark item."""
    path = new_folder(spark, "raw")
    (table(spark, base, "benchmark").select(F.col("item_id").alias("item"), "text")
     .repartition("item").write.partitionBy("item").text(path))
    files = lake.raw_manifest(spark, path, source="benchmark").filter(F.col("original_filename").startswith("part-"))
    return files.select(F.regexp_extract("path", "item=([0-9]+)", 1).cast("long").alias("item_id"),
                        "file_size_bytes", "md5_hash", "source")


# --- versions ------------------------------------------------------------------

def two_versions(spark: SparkSession, base: str) -> str:
    """v2 holds all labelled documents, v10 the Real ones."""
    path = new_folder(spark, "processed/lake")
    rows = corpus(spark, base).select("doc_id", "label", F.md5("text").alias("text_md5"))
    lake.write_version(rows, path, "processed", "docs", "v2")
    lake.write_version(D.keep_classes(rows, ["Real"]), path, "processed", "docs", "v10")
    return path


@query
def write_version(spark, base):
    return lake.read_version(spark, two_versions(spark, base), "processed", "docs", "v2")


@query
def read_version(spark, base):
    return lake.read_version(spark, two_versions(spark, base), "processed", "docs", natural=True)


@query
def list_versions(spark, base):
    """Every version with its rows."""
    path = two_versions(spark, base)
    parts = [lake.read_version(spark, path, "processed", "docs", v).agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit(v).alias("version"), "n") for v in lake.list_versions(spark, path)]
    return D.union_sources(*parts)


@query
def write_word_vectors(spark, base):
    path = new_folder(spark, "vectors")
    rows = table(spark, base, "embeddings").select(F.col("vec_id").cast("string").alias("word"),
                                                   F.col("embedding").alias("vector"))
    lake.write_word_vectors(rows, path, "v1")
    back = lake.read_version(spark, path, "embeddings", "word2vec")
    shown = F.transform("vector", lambda x: F.format_string("%.6f", x.cast("double")))
    return back.select(F.col("word").cast("long").alias("word"), F.array_join(shown, " ").alias("vector"))


@query
def model_tables(spark, base):
    """Fitted log likelihoods, saved and loaded."""
    path = new_folder(spark, "models")
    docs, rows = nb_rows(spark, base)
    lake.save_model_tables(path, "v1", {"loglik": nb_params(docs, rows)[0]})
    return NB.unpivot_classes(lake.load_model_tables(spark, path, "v1", ["loglik"])["loglik"], "ll_", "ll", ["term"])


# --- logs, runs, scorecards ----------------------------------------------------

def request_log(spark: SparkSession, base: str) -> DataFrame:
    """A service log with one response per event: its type as path, its value in
    tenths of a millisecond, an error status where the value is high."""
    path, tenths = new_folder(spark, "log"), F.floor(F.abs("value") * 10)
    events = table(spark, base, "events").withColumn("t", tenths)
    head = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" | INFO | api | RESPONSE | POST /"), "event_type")
    status = F.when(F.col("t") % 10 == 0, F.lit("422")).otherwise(F.lit("200"))
    line = F.concat(head, F.lit(" | Status: "), status, F.lit(" | Time: "), F.expr("t div 10").cast("string"), F.lit("."),
                    (F.col("t") % 10).cast("string"), F.lit("ms"))
    events.select(line.alias("value")).write.text(path)
    return readers.read_request_log(spark, path)


@query
def read_request_log(spark, base):
    return request_log(spark, base).select(F.col("ts").cast("timestamp_ntz").alias("ts"), "level", "kind", "method", "path", "status", "ms")


@query
def request_summary(spark, base):
    return G.request_summary(request_log(spark, base))


def recorded_runs(spark: SparkSession, base: str) -> DataFrame:
    """The strengths of the Naive Bayes sweep as runs of one file per key."""
    root, jvm = new_folder(spark, "runs"), spark._jvm
    for i, r in enumerate(nb_alpha_sweep(spark, base).orderBy("alpha").collect()):
        for key, value in {"params/alpha": f"{r.alpha}\nsmoothing", "params/max_features": str(1000 * (i + 1)),
                           "params/stopword_list": ("standard", "custom")[i % 2], "params/min_token_length": str(i),
                           "params/normalization_method": ("none", "stem", "lemma")[i % 3],
                           "metrics/accuracy": f"1 0.0 0\n2 {r.accuracy:.6f} 1", "metrics/f1_weighted": f"2 {r.f1:.6f} 0"}.items():
            where = jvm.org.apache.hadoop.fs.Path(f"{root}/exp/run{i}/{key}")
            out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where)
            out.write(bytearray(value.encode()))
            out.close()
    return runs.read_runs(spark, root)


@query
def read_runs(spark, base):
    rows = recorded_runs(spark, base)
    return rows.select("run_id", F.element_at("params", "alpha").alias("alpha"),
                       F.element_at("params", "max_features").alias("max_features"),
                       F.element_at("metrics", "accuracy").alias("accuracy"),
                       F.element_at("metrics", "f1_weighted").alias("f1"), "ts")


@query
def compare_runs(spark, base):
    return R.compare_runs(recorded_runs(spark, base))


@query
def log_run(spark, base):
    path = new_folder(spark, "logged")
    for r in nb_alpha_sweep(spark, base).collect():
        R.log_run(spark, path, f"a{r.alpha}", {"alpha": r.alpha}, {"f1": r.f1})
    return spark.read.parquet(path).select("run_id", F.element_at("params", "alpha").alias("alpha"),
                                           F.element_at("metrics", "f1").alias("f1"))


def cards(spark: SparkSession, base: str) -> DataFrame:
    """A card per source of the documents: volume, variety and length up to 5."""
    facts = table(spark, base, "documents").groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("lang").alias("langs"), F.avg("n_chars").alias("mean"))
    scores = {"volume": F.least(F.expr("n div 10"), F.lit(5)), "variety": F.least("langs", F.lit(5)),
              "length": F.least(F.floor(F.col("mean") / 500), F.lit(5))}
    entries = [F.struct(F.lit(k).alias("k"), F.struct(v.cast("int").alias("score"), F.lit(k).alias("justification")).alias("v"))
               for k, v in scores.items()]
    one = facts.select("source", F.map_from_entries(F.array(*entries)).alias("c"))
    return one.agg(F.map_from_entries(F.collect_list(F.struct("source", "c"))).alias("cards"))


@query
def scorecards(spark, base):
    path = new_folder(spark, "cards")
    runs.write_scorecards(cards(spark, base), path)
    rows = runs.read_scorecards(spark, path).select(F.explode("cards").alias("source", "criteria"))
    return rows.select("source", F.explode("criteria").alias("criterion", "e")).select("source", "criterion", "e.score")


@query
def scorecard_totals(spark, base):
    return runs.scorecard_totals(cards(spark, base))


# --- streams -------------------------------------------------------------------

def run_once(stream: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Everything a stream gives for the input there is, as a table."""
    path = new_folder(spark, name)
    job = (stream.writeStream.format("parquet").option("path", f"{path}/out").outputMode("append")
           .option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start())
    job.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


def as_stream(df: DataFrame, name: str) -> DataFrame:
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).parquet(path)


@query
def quota_stream(spark, base):
    """Minutes that are closed at the end of the events."""
    events = as_stream(table(spark, base, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts")), "events")
    closed = run_once(jobs.quota_stream(events, G.BATCH_QUOTA), spark, "quota")
    return closed.withColumn("minute", F.col("minute").cast("timestamp_ntz"))


@query
def dedup_stream(spark, base):
    turns = table(spark, base, "conversations").select(
        "text", F.timestamp_seconds(F.lit(1_700_000_000)).alias("ts"))
    return run_once(jobs.dedup_stream(as_stream(turns, "turns")), spark, "distinct").select(
        F.md5("text").alias("text_md5"))


@query
def score_stream(spark, base):
    model, path = scoring_model(spark, base), new_folder(spark, "scored")
    job = jobs.score_stream(as_stream(conversations(spark, base), "texts"), model, f"{path}/out", f"{path}/state")
    job.trigger(availableNow=True).start().awaitTermination()
    back = spark.read.parquet(f"{path}/out")
    return back.select("doc_id", "prediction", "confidence",
                       *[F.element_at("class_probabilities", c).alias(f"p_{c}") for c in CLASSES])


# --- counts and sketches that grow with the data -------------------------------

def refreshed_state(spark: SparkSession, base: str) -> DataFrame:
    """All labelled documents are counted first; then those of bad quality are
    withdrawn and the benchmark items come in as Real, by their changes alone."""
    path = new_folder(spark, "counts")
    docs = prepared_documents(spark, base).select("doc_id", "label", "tokens")
    C.refresh(spark, path, "counts", "v1", docs.withColumn("sign", F.lit(1)))
    bad = table(spark, base, "labels").filter("quality = 0").select("doc_id")
    gone = docs.join(bad, "doc_id", "left_semi").withColumn("sign", F.lit(-1))
    new = query_texts(spark, base).select("doc_id", F.lit("Real").alias("label"), "tokens", F.lit(1).alias("sign"))
    return C.refresh(spark, path, "counts", "v2", gone.unionByName(new), since="v1")


@query
def refreshed_counts(spark, base):
    return refreshed_state(spark, base)


@query
def refreshed_vocabulary(spark, base):
    return C.vocabulary_of(refreshed_state(spark, base))


@query
def sketch_errors(spark, base):
    """Daily sketches merged over all days, against the events themselves."""
    events = table(spark, base, "events").select("event_type", "user_id", "value", F.to_date("ts").alias("day"))
    kind = ["event_type"]
    daily = materialize(S.sketched(events, [*kind, "day"], "user_id", "value"), "daily")
    whole = S.estimates(S.merged(daily, kind), kind)
    halves = S.merged(daily.withColumn("half", F.dayofmonth("day") % 2), [*kind, "half"])
    twice = S.estimates(S.merged(halves, kind), kind).select(*kind, F.col("n_distinct").alias("again"))
    at = lambda p, q: ((F.sum((F.col("value") < F.col(p)).cast("long")) <= (q + S.RANK_ERROR) * F.count("value"))
                       & (F.sum((F.col("value") <= F.col(p)).cast("long")) >= (q - S.RANK_ERROR) * F.count("value")))
    far = F.abs(F.first("n_distinct") - F.count_distinct("user_id"))
    return events.join(whole.join(twice, kind), kind).groupBy(*kind).agg(
        F.first("n").alias("n"), (far <= S.DISTINCT_ERROR * F.count_distinct("user_id")).cast("int").alias("distinct_within"),
        at("p50", 0.5).cast("int").alias("p50_within"), at("p95", 0.95).cast("int").alias("p95_within"),
        (F.first("n_distinct") == F.first("again")).cast("int").alias("halves_equal"))
