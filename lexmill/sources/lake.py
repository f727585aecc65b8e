"""Versioned tables in layers of a shared folder, and raw-file manifests."""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.ml.util import MLReadable, MLWritable
from pyspark.sql import DataFrame, SparkSession, functions as F

LAYERS = ("raw", "processed", "embeddings")


def write_corpus(df: DataFrame, path: str) -> None:
    """Parquet and CSV copies of a corpus."""
    df.write.mode("overwrite").parquet(f"{path}/parquet")
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{path}/csv")


def raw_manifest(spark: SparkSession, path: str, **metadata: str) -> DataFrame:
    """One row per raw file: path, filename, size, md5, times, object key, and
    any metadata given.  Files are hashed by the tasks that read them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.regexp_extract("path", "([^/]+)$", 1)
    now = F.current_timestamp()
    rows = files.select(
        "path", name.alias("original_filename"), F.col("length").alias("file_size_bytes"),
        F.md5("content").alias("md5_hash"), F.col("modificationTime").alias("modified"),
        now.alias("upload_timestamp"),
        F.concat(F.date_format(now, "yyyyMMdd_HHmmss"), F.lit("/"), name).alias("object_name"))
    return rows.withColumns({k: F.lit(v) for k, v in metadata.items()}) if metadata else rows


def _files(spark: SparkSession, path: str):
    """A path and its file system, through Spark's own layer."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _record(base: str, layer: str, name: str, version: str) -> str:
    return f"{base}/{layer}/{version}/_commits/{name}"


def _committed(spark: SparkSession, record: str) -> str | None:
    """The folder that a commit record names, None where there is no record or a
    writer ended before it was written out."""
    where, files = _files(spark, record)
    if not files.exists(where):
        return None
    stream = files.open(where)
    try:
        return bytes(stream.readAllBytes()).decode() or None
    finally:
        stream.close()


def _commit(spark: SparkSession, record: str, folder: str) -> None:
    """Create the record.  Creation fails where one exists, so of several writers
    one wins."""
    where, files = _files(spark, record)
    try:
        out = files.create(where, False)
    except Py4JJavaError as e:
        if files.exists(where):
            raise FileExistsError(f"already committed: {record}") from e
        raise
    out.write(bytearray(folder.encode()))
    out.close()


def write_version(df: DataFrame, base: str, layer: str, name: str, version: str) -> str:
    """Write a table as a version of a layer and commit it; returns its folder.

    Each attempt writes a folder of its own, and a record that names the folder is
    written last: a version whose writer died is never listed or read.  What is
    committed is not written again: a later or concurrent writer of the same table
    and version gets FileExistsError, and readers keep the folder they pinned.
    """
    if layer not in LAYERS:
        raise ValueError(f"unknown layer: {layer}")
    spark, record = df.sparkSession, _record(base, layer, name, version)
    if _committed(spark, record):
        raise FileExistsError(f"already committed: {record}")
    folder = f"{name}/{uuid.uuid4().hex}"
    df.write.parquet(f"{base}/{layer}/{version}/{folder}")
    _commit(spark, record, folder)
    return f"{base}/{layer}/{version}/{folder}"


def write_word_vectors(vectors: DataFrame, base: str, version: str, name: str = "word2vec") -> str:
    """(word, vector) tables in the embeddings layer."""
    return write_version(vectors.select("word", "vector"), base, "embeddings", name, version)


def list_versions(spark: SparkSession, base: str, layer: str = "processed") -> list[str]:
    """Sorted names of the versions of a layer that hold a committed table; names
    with a leading `_` are hidden.

    Folders and records are listed, however many files the versions hold.
    """
    root, files = _files(spark, f"{base}/{layer}")
    if not files.exists(root):
        return []
    names = [s.getPath().getName() for s in files.listStatus(root) if s.isDirectory()]
    return sorted(n for n in names if not n.startswith("_") and _tables(spark, f"{base}/{layer}/{n}"))


def _tables(spark: SparkSession, version: str) -> list[str]:
    """Names of the committed tables of a version: records that were written out."""
    where, files = _files(spark, f"{version}/_commits")
    if not files.exists(where):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(where) if s.getLen() > 0)


def _natural(version: str) -> list:
    return [(0, int(p), "") if p.isdigit() else (1, 0, p) for p in re.split(r"(\d+)", version) if p]


def read_version(spark: SparkSession, base: str, layer: str, name: str, version: str = "latest",
                 natural: bool = False) -> DataFrame:
    """A given or the latest version, pinned to the folder of its commit record.
    Latest is the last name in text order that has the table, or, with `natural`,
    with numbers compared as numbers."""
    if version == "latest":
        versions = [v for v in list_versions(spark, base, layer) if name in _tables(spark, f"{base}/{layer}/{v}")]
        if not versions:
            raise FileNotFoundError(f"no versions of {name} in layer {layer}")
        version = max(versions, key=_natural) if natural else versions[-1]
    folder = _committed(spark, _record(base, layer, name, version))
    if not folder:
        raise FileNotFoundError(f"no version {version} of {name} in layer {layer}")
    return spark.read.parquet(f"{base}/{layer}/{version}/{folder}")


def save_model_tables(base: str, version: str, tables: dict[str, DataFrame],
                      models: dict[str, MLWritable] | None = None) -> None:
    """Fitted parameter tables, and Spark ML models, of one version."""
    for name, df in tables.items():
        write_version(df, base, "processed", name, version)
    for name, model in (models or {}).items():
        model.write().overwrite().save(f"{base}/processed/{version}/{name}")


def load_model(base: str, version: str, name: str, kind: type[MLReadable]):
    """A Spark ML model saved by `save_model_tables`; `kind` is its class."""
    return kind.load(f"{base}/processed/{version}/{name}")


def load_model_tables(spark: SparkSession, base: str, version: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: read_version(spark, base, "processed", n, version) for n in names}
