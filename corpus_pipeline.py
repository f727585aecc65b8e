"""The corpus pipeline: documents to packed training batches, stage by stage.

Each stage works on all that its predecessor kept, written as Parquet to the
shared folder, so a lost executor costs at most one stage.

    quality    documents whose quality score is under the limit go
    near       one document of each near-duplicate group stays: three-word shingles,
               fingerprints at most 3 bits apart
    passages   repeated passages are cut out of all but their first place;
               documents of which nothing is left go
    benchmark  rows that hold a benchmark item go
    packing    every document gets its length bucket, batch and place

Cases: a document that no stage's decision touches keeps its row unchanged; null
texts count as empty and pass like any text; rows without a doc_id are scored,
never folded or cut, checked against the benchmark each on its own text and
packed; equal rows of a doc_id become one in the near-duplicate stage, rows of one
doc_id with different texts are decided each on its own; an empty table stays empty through
all stages; extra columns are carried to the last stage, which returns its own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lexmill.llm import decontaminate, packing, passages, quality, simhash_dedup
from lexmill.llm.shared import table
from lexmill.session import shared_folder


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.keep_one(docs)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return passages.without_repeats(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("passages", passage_stage),
    ("benchmark", benchmark_stage),
    ("packing", packing_stage),
]

# Fitted rules, fingerprints and alignments are beyond SQL; the stages are tested
# against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline_{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
