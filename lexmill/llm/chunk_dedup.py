"""Exact duplicates by content-defined chunk recipes, with column expressions only.

1. A text, A-Z lower-cased, is cut where its own bytes say so: behind three bytes
   of given classes, MIN_CHUNK bytes after the last cut at the earliest and
   MAX_CHUNK at the latest.  Equal texts are cut alike, and texts that differ in
   one place have the same chunks before and behind it.
2. One pass over the texts writes, per document, its chunks and its recipe: the
   ordered 64-bit digests of its chunks.
3. Chunks are deduplicated by digest and content, first in each task, so a chunk
   is moved once per task however many documents hold it.  That verifies the
   digests: one that stands for several contents is a clash, and each of its
   contents gets a number.  Digest and number identify a chunk exactly.
4. Documents are equal when their ordered lists of identifiers are equal.  Only
   these lists, 8 bytes per chunk, are grouped and joined; the long texts stay
   where they are.

Of equal texts the row with the largest doc_id stays.  Cases: a null text counts
as empty, and all empty texts are equal; a null doc_id is smaller than any other;
of rows with equal doc_id and equal text one stays, all count in group_size; an
empty table gives an empty result; extra columns are ignored, or kept where rows
are returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexmill.llm.shared import materialize

MIN_CHUNK = 1024
MAX_CHUNK = 8192
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _bytes_where(test) -> str:
    return "[" + "".join(f"\\x{b:02x}" for b in range(256) if test(b)) + "]"


def chunk_pattern(least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> str:
    """Pattern of one chunk over bytes read as Latin-1.  A cut follows three
    bytes, each of a class that holds every eighth byte value, spread by a
    multiplier over letters and other bytes alike."""
    edge = "".join(_bytes_where(lambda b, m=m: b * m % 257 % 8 == 3) for m in (11, 3, 107))
    return f"(?s).{{{least - 3},{most - 3}}}?{edge}|.{{1,{most}}}"


def normalised(text: str | Column) -> Column:
    return F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), _UPPER, _UPPER.lower())


def recipes(docs: DataFrame, digest_bits: int = 64, carry: bool = False) -> DataFrame:
    """(row, doc_id, text_sha256, recipe, chunks), written to the shared folder;
    `row` numbers the rows.  With `carry`, also `doc`, the whole row."""
    own = [F.struct("*").alias("doc")] if carry else []
    texts = docs.select("doc_id", normalised("text").alias("norm"), *own)
    as_bytes = F.decode(F.encode("norm", "UTF-8"), "ISO-8859-1")
    cut = texts.select("doc_id", F.sha2("norm", 256).alias("text_sha256"),
                       F.regexp_extract_all(as_bytes, F.lit(chunk_pattern()), F.lit(0)).alias("chunks"),
                       *["doc"][:len(own)])
    kept = F.lit(-1 if digest_bits == 64 else (1 << digest_bits) - 1).cast("long")
    cut = cut.withColumn("recipe", F.transform("chunks", lambda c: F.xxhash64(c).bitwiseAND(kept)))
    return materialize(cut.withColumn("row", F.monotonically_increasing_id()), "recipes")


def clashes(cut: DataFrame) -> DataFrame:
    """(digest): those that stand for more than one content."""
    chunks = cut.select(F.explode(F.arrays_zip("recipe", "chunks")).alias("c"))
    contents = chunks.groupBy(F.col("c.recipe").alias("digest"), F.col("c.chunks").alias("chunk")).agg(
        F.count(F.lit(1)).alias("n"))
    return materialize(contents.groupBy("digest").agg(F.count(F.lit(1)).alias("contents"))
                       .filter(F.col("contents") > 1).select("digest"), "clashes")


def _numbers(cut: DataFrame, clash: DataFrame) -> DataFrame:
    """(row, numbers): for documents with chunks of clashing digests, the place
    in the recipe and the number of the content of each such chunk."""
    chunks = cut.select("row", F.posexplode(F.arrays_zip("recipe", "chunks")).alias("place", "c")).select(
        "row", "place", F.col("c.recipe").alias("digest"), F.col("c.chunks").alias("chunk"))
    chunks = chunks.join(clash, "digest")
    contents = chunks.select("digest", "chunk").distinct().withColumn(
        "number", F.row_number().over(Window.partitionBy("digest").orderBy("chunk")))
    found = chunks.join(contents, ["digest", "chunk"]).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("place", "number"))).alias("numbers"))
    return materialize(found, "chunk_numbers")


def _groups(cut: DataFrame) -> DataFrame:
    """(row, doc_id, text_sha256, keep, group_size) of all rows; `keep` is the
    (doc_id, row) that stays."""
    clash = clashes(cut)
    named = cut.select("row", "doc_id", "text_sha256", "recipe")
    if clash.isEmpty():
        none = F.array().cast("array<struct<place:int,number:int>>")
        named = named.withColumn("numbers", none)
    else:
        named = named.join(_numbers(cut, clash), "row", "left").withColumn(
            "numbers", F.coalesce("numbers", F.array()))
    groups = named.groupBy("recipe", "numbers").agg(
        F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    groups = materialize(groups, "chunk_groups")
    return named.join(groups, ["recipe", "numbers"]).drop("recipe", "numbers")


def exact_groups(docs: DataFrame, digest_bits: int = 64) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row per row of `docs`.

    `digest_bits` shortens the digests, so that clashes can be tried out."""
    found = _groups(recipes(docs, digest_bits))
    return found.select("doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
                        (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256")


def without_copies(docs: DataFrame, digest_bits: int = 64) -> DataFrame:
    """`docs` with the one row of each group of equal texts that stays."""
    cut = recipes(docs, digest_bits, carry=True)
    kept = _groups(cut).filter(F.col("row") == F.col("keep.row")).select("row")
    return cut.select("row", "doc").join(kept, "row").select("doc.*")
