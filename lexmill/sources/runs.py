"""Recorded experiment runs and reliability scorecards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SCORECARDS = "map<string,map<string,struct<score:int,justification:string>>>"
MAX_SCORE = 25


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    """(run_id, params, metrics, ts) from one file per key, laid out as
    experiment/run/params/key and experiment/run/metrics/key.

    A parameter is its whole file, in any number of lines; a metric line is
    `epoch_ms value step`, of which the last step counts.
    """
    def entries(kind: str, whole: bool) -> DataFrame:
        lines = spark.read.text(f"{root}/*/*/{kind}/*", wholetext=whole)
        place = rf"/([^/]+)/{kind}/([^/]+)$"
        return lines.select(
            *[F.regexp_extract(F.col("_metadata.file_path"), place, i).alias(n)
              for i, n in ((1, "run_id"), (2, "key"))], F.trim("value").alias("value"))

    parts = F.split("value", " ")
    params = (entries("params", True).groupBy("run_id")
              .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "value")))).alias("params")))
    last = (entries("metrics", False).groupBy("run_id", "key")
            .agg(F.max(F.struct(F.get(parts, 2).cast("long").alias("step"),
                                F.get(parts, 0).cast("long").alias("at"),
                                F.get(parts, 1).cast("double").alias("value"))).alias("m")))
    metrics = last.groupBy("run_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", F.col("m.value").alias("value")))))
        .alias("metrics"), F.max("m.at").alias("ts"))
    return params.join(metrics, "run_id", "full").select("run_id", "params", "metrics", "ts")


def read_scorecards(spark: SparkSession, path: str) -> DataFrame:
    """The scorecard document as one map column `cards`."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.from_json("value", SCORECARDS).alias("cards"))


def write_scorecards(df: DataFrame, path: str) -> None:
    df.select(F.to_json("cards").alias("value")).write.mode("overwrite").text(path)


def scorecard_totals(df: DataFrame) -> DataFrame:
    """Total score per source, out of 25."""
    sources = df.select(F.explode("cards").alias("source", "criteria"))
    scores = sources.select("source", F.explode("criteria").alias("criterion", "entry"))
    return scores.groupBy("source").agg(F.sum("entry.score").alias("total"),
                                        F.lit(MAX_SCORE).alias("out_of"))
