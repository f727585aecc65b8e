"""Readers of the raw corpora and of the service log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

# Columns of the headerless statements file.
STATEMENT_SCHEMA = (
    "id string, label string, statement string, subject string, speaker string, "
    "job_title string, state_info string, party string, barely_true int, false_count int, "
    "half_true int, mostly_true int, pants_on_fire int, context string"
)

# Fixed patterns: log lines `time | level | logger | message`, and messages.
LOG_LINE = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) \| (\w+) \| ([^|]+) \| (REQUEST|RESPONSE|ERROR) \| (\S+) (\S+) \| (.*)$"
LOG_CLIENT = r"^Client: (\S+) \| Query: (.*)$"
LOG_STATUS = r"Status: (\d+)"
LOG_TIME = r"Time: ([0-9.]+)\s?ms"


def _without_long_lines(df: DataFrame, n_columns: int, sep: str) -> DataFrame:
    """Drop lines with more fields than columns.  Shorter lines stay, padded
    with nulls, and so do fields of the wrong type, as null."""
    outside_quotes = sep + r'(?=(?:[^"]*"[^"]*")*[^"]*$)'
    fields = F.size(F.split("_corrupt_record", outside_quotes))
    return (df.filter(F.col("_corrupt_record").isNull() | (fields <= n_columns))
            .drop("_corrupt_record"))


def read_statements_tsv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Headerless tab-separated statements; lines with extra fields are skipped.

    Column pruning is off in the parser, or a line's field count would only be
    checked when all columns are read.
    """
    rows = (spark.read.schema(STATEMENT_SCHEMA + ", _corrupt_record string").option("sep", "\t")
            .option("columnPruning", False).csv(list(paths) if not isinstance(paths, str) else paths))
    return _without_long_lines(rows, STATEMENT_SCHEMA.count(",") + 1, "\t")


def read_titles_csv(spark: SparkSession, paths_with_label: Mapping[str, str] | Sequence[tuple[str, str]]) -> DataFrame:
    """CSV files with a header, each tagged with the class of its role."""
    pairs = paths_with_label.items() if isinstance(paths_with_label, Mapping) else paths_with_label
    frames = []
    for path, label in pairs:
        reader = spark.read.option("header", True).option("escape", '"')
        names = reader.csv(path).columns
        schema = ", ".join(f"`{n}` string" for n in [*names, "_corrupt_record"])
        rows = (reader.schema(schema).option("columnPruning", False).option("multiLine", True).csv(path))
        frames.append(_without_long_lines(rows, len(names), ",").withColumn("label", F.lit(label)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_headlines_json(spark: SparkSession, path: str) -> DataFrame:
    """One JSON array of objects with `headline` and `is_sarcastic`."""
    return (spark.read.schema("headline string, is_sarcastic int, article_link string")
            .option("multiLine", True).json(path))


def read_request_log(spark: SparkSession, path: str) -> DataFrame:
    """(ts, level, kind, method, path, client, query, status, ms); lines of any
    other form are dropped."""
    lines = spark.read.text(path).filter(F.col("value").rlike(LOG_LINE))
    part = lambda i: F.regexp_extract("value", LOG_LINE, i)
    rows = lines.select(
        F.to_timestamp(part(1), "yyyy-MM-dd HH:mm:ss").alias("ts"), part(2).alias("level"),
        part(4).alias("kind"), part(5).alias("method"), part(6).alias("path"), part(7).alias("rest"))
    found = lambda pattern, i: F.nullif(F.regexp_extract("rest", pattern, i), F.lit(""))
    return rows.select(
        "ts", "level", "kind", "method", "path",
        found(LOG_CLIENT, 1).alias("client"), found(LOG_CLIENT, 2).alias("query"),
        found(LOG_STATUS, 1).cast("int").alias("status"), found(LOG_TIME, 1).cast("double").alias("ms"))
