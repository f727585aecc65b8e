"""Token counts by source, language and tokenizer version, kept by deltas.

A batch is a table of signed changes: +1 document and its tokens for an insert,
-1 and minus its tokens for a delete, 0 and the difference for a revised count.
Changes are additive, so a batch folds to one row a key before it is stored, and
totals are the sum over batches in any order.

Commits are idempotent: a batch is a folder named by its id under the rollup's
path, and counts once Spark's commit has left its success mark.  Committing a
batch again changes nothing; a batch that died half-way has no mark and is
written anew.  `compact` folds the batches of a rollup to one, whose mark names
what it covers, so a crash between writing and clearing counts nothing twice.

Cases: null source, language or version is a key of its own; null and empty texts
have zero tokens and count as documents; an empty batch is committed as such; a
key whose counts return to zero stays with zeros; repeated rows are separate
changes; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

KEYS = ("source", "lang", "tokenizer")
_SCHEMA = "source string, lang string, tokenizer string, docs long, tokens long"

# Version name -> what one token is.
TOKENIZERS = {
    "words-1": r"[^ \t\n\x0B\f\r]+",
    "pieces-1": r"\p{L}+|\p{N}|[^\p{L}\p{N} \t\n\x0B\f\r]",
}


def count_tokens(text: Column, version: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKENIZERS[version])), F.lit(0)).cast("long")


def _long(docs: DataFrame, signs: Column, counts: dict[str, Column], carry: Sequence[str]) -> DataFrame:
    """One change for each row and tokenizer version, with the columns `carry`."""
    each = F.array(*[F.struct(F.lit(v).alias("tokenizer"), c.alias("tokens")) for v, c in counts.items()])
    return docs.select(F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
                       signs.cast("long").alias("docs"), F.inline(each), *carry).select(
        *KEYS, "docs", "tokens", *carry)


def inserts(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Changes are narrow: join or filter them rather than the texts, by `carry`."""
    return _long(docs, F.lit(1), {v: count_tokens(F.col("text"), v) for v in TOKENIZERS}, carry)


def deletes(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return _long(docs, F.lit(-1), {v: -count_tokens(F.col("text"), v) for v in TOKENIZERS}, carry)


def revisions(docs: DataFrame, new_text: str, carry: Sequence[str] = ()) -> DataFrame:
    """Changes of documents whose `text` is replaced by the column `new_text`."""
    return _long(docs, F.lit(0), {v: count_tokens(F.col(new_text), v) - count_tokens(F.col("text"), v)
                                  for v in TOKENIZERS}, carry)


class Rollup:
    """A rollup stored under one folder all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _files(self):
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return root, root.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def batches(self) -> list[str]:
        """Folders of the committed batches that count, oldest name first."""
        root, fs, path = self._files()
        if not fs.exists(root):
            return []
        names = sorted(s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()
                       and fs.exists(path(s.getPath(), "_SUCCESS")))
        covered = set()
        for name in names:
            if name.startswith("compact="):
                stream = fs.open(path(root, f"{name}/_COVERS"))
                covered.update(bytes(stream.readAllBytes()).decode().split("\n"))
                stream.close()
        return [n for n in names if n not in covered]

    def _known(self, name: str) -> bool:
        root, fs, path = self._files()
        if fs.exists(path(root, f"{name}/_SUCCESS")):
            return True
        return any(fs.exists(path(s.getPath(), "_SUCCESS")) and name in self._covers(s.getPath().getName())
                   for s in (fs.listStatus(root) if fs.exists(root) else [])
                   if s.getPath().getName().startswith("compact="))

    def _covers(self, name: str) -> list[str]:
        root, fs, path = self._files()
        stream = fs.open(path(root, f"{name}/_COVERS"))
        try:
            return bytes(stream.readAllBytes()).decode().split("\n")
        finally:
            stream.close()

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch; False where it was committed before."""
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
            raise ValueError("a batch id has letters, digits, dots, dashes and underscores")
        name = f"batch={batch}"
        if self._known(name):
            return False
        folded = changes.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        folded.write.mode("overwrite").parquet(f"{self.path}/{name}")
        return True

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens) over all committed batches."""
        parts = [self.spark.read.schema(_SCHEMA).parquet(f"{self.path}/{n}") for n in self.batches()]
        if not parts:
            return self.spark.createDataFrame([], _SCHEMA)
        return reduce(DataFrame.union, parts).groupBy(*KEYS).agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))

    def compact(self) -> str | None:
        """Fold the batches that count to one; returns its folder."""
        names = self.batches()
        if len(names) < 2:
            return None
        root, fs, path = self._files()
        covered = [n for name in names for n in ([name] + (self._covers(name) if name[:8] == "compact=" else []))]
        taken = [s.getPath().getName() for s in fs.listStatus(root)]
        number = 1 + max([int(n[8:]) for n in taken if re.fullmatch(r"compact=\d+", n)], default=0)
        name = f"compact={number}"
        done = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
        self.totals().write.option(done, "false").mode("overwrite").parquet(f"{self.path}/{name}")
        for mark, content in (("_COVERS", "\n".join(covered)), ("_SUCCESS", "")):
            stream = fs.create(path(root, f"{name}/{mark}"), True)
            stream.write(bytearray(content.encode()))
            stream.close()
        return name
