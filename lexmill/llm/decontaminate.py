"""Benchmark decontamination with column expressions only.

1. Words are runs of letters and digits, lower-cased; a shingle is five words.
   An item of n words has n - 4 shingles (fewer than five words: one shingle of
   all of them).
2. Windows of exactly an item's size are laid over a document where one of its
   shingles stands at an item's offset: a window without a common shingle has
   similarity 0, so no window that could match is left out.  The shingles of the
   benchmark are the only table that is broadcast, in blocks of at most
   LOOKUP_ROWS rows; documents are read once per block.
3. Windows of equal content fold to one before the costly steps, so a passage
   that a third of all documents share is one row.
4. SimHash of every window and item.  The 64 bits are cut into five blocks; two
   values within RADIUS = 19 bits agree in some block up to 3 bits, so the
   items are filed under all block values at most 3 bits away and windows look
   up their own block values.  All pairs within the radius are found.
5. Candidates are verified by the exact similarity of their weighted shingles,
   sum of smaller over sum of larger weights; a weight is how often the shingle
   occurs.

Cases: null or empty texts and items without a word never match; a document
shorter than the item is compared whole; windows that would leave a document
are moved inside; repeated rows of one doc_id and text count once; rows with
equal doc_id and other texts are each examined; a null doc_id is a document like
any other; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from lexmill.llm.shared import materialize

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 19
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))   # first bit, bits
LOOKUP_ROWS = 500_000


def words(text: str | Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingle_hashes(tokens: Column, size: int) -> Column:
    """Hashes of the shingles of `size` words, in order."""
    last = F.size(tokens) - (size - 1)
    at = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.slice(tokens, i, size)))


def _flip_masks(bits: int, radius: int) -> Column:
    masks = [sum(1 << b for b in chosen) for r in range(radius + 1)
             for chosen in combinations(range(bits), r)]
    return F.lit(np.array(sorted(masks), dtype=np.int64))


def _lane_sums() -> list[Column]:
    """Set bits per position, two positions to a sum of 32 bits each."""
    lanes = F.lit(0x0000000100000001)
    return [F.sum(F.shiftrightunsigned("hash", i).bitwiseAND(lanes) * F.col("weight")).alias(f"s{i}")
            for i in range(32)]


def simhash(shingles: DataFrame, keys: list[str]) -> DataFrame:
    """(keys…, fp) of (keys…, hash, weight): a bit is set where over half the
    weight has it."""
    sums = shingles.groupBy(*keys).agg(F.sum("weight").alias("total"), *_lane_sums())
    fp = F.lit(0).cast("long")
    for i in range(32):
        low = F.col(f"s{i}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(F.col(f"s{i}"), 32)
        for bit, n in ((i, low), (i + 32, high)):
            one = F.lit(1 << bit if bit < 63 else -(1 << 63)).cast("long")
            fp = fp.bitwiseOR(F.when(2 * n > F.col("total"), one).otherwise(F.lit(0).cast("long")))
    return sums.select(*keys, fp.alias("fp"))


def _item_table(items: DataFrame) -> DataFrame:
    """(item_id, n, size, shingles): items with at least one word."""
    parts = items.select("item_id", words("text").alias("w")).filter(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(SHINGLE))
    hashes = F.coalesce(*[F.when(size == s, shingle_hashes(F.col("w"), s)) for s in range(1, SHINGLE + 1)])
    return parts.select("item_id", F.size("w").alias("n"), size.alias("size"), hashes.alias("shingles"))


def _hits(docs: DataFrame, lookup: DataFrame, size: int) -> DataFrame:
    """(row, nw, n, start): where windows of item size lie, each once."""
    at = docs.select("row", words("text").alias("w"))
    at = at.select("row", F.size("w").alias("nw"), F.posexplode(shingle_hashes(F.col("w"), size)).alias("pos", "hash"))
    blocks = -(-lookup.count() // LOOKUP_ROWS)
    found = None
    for b in range(blocks):
        part = lookup.filter(F.pmod(F.col("hash"), F.lit(blocks)) == b)
        hit = at.join(F.broadcast(part), "hash")
        found = hit if found is None else found.union(hit)
    inside = F.greatest(F.lit(0), F.least(F.col("pos") - F.col("offset"), F.col("nw") - F.col("n")))
    return found.select("row", "n", inside.alias("start")).distinct()


def _windows(docs: DataFrame, lookup: DataFrame, size: int) -> DataFrame:
    """(row, doc_id, n, start, shingles): the windows with their content."""
    hits = materialize(_hits(docs, lookup, size), "windows")
    hit_rows = hits.select("row").distinct()
    texts = (docs.join(hit_rows, "row", "left_semi")
             .dropDuplicates(["row"]).select("row", "doc_id", words("text").alias("w"))
             .select("row", "doc_id", shingle_hashes(F.col("w"), size).alias("all")))
    return texts.join(hits, "row").select(
        "row", "doc_id", "n", "start",
        F.slice("all", F.col("start") + 1, F.greatest(F.col("n") - (size - 1), F.lit(1))).alias("shingles"))


def _candidates(contents: DataFrame, items: DataFrame, radius: int) -> DataFrame:
    """(n, content, item_id): fingerprints of equal window size within the radius."""
    near = radius // len(BLOCKS)

    def block(i: int) -> Column:
        first, bits = BLOCKS[i]
        return F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << bits) - 1))

    def filed(i: int) -> Column:
        return F.transform(_flip_masks(BLOCKS[i][1], near), lambda m: F.struct(
            F.lit(i).alias("block"), block(i).bitwiseXOR(m).alias("value")))

    index = items.select("n", "item_id", F.col("fp").alias("item_fp"), F.inline(
        F.concat(*[filed(i) for i in range(len(BLOCKS))])))
    looked = contents.select("n", "content", "fp", F.inline(F.array(*[
        F.struct(F.lit(i).alias("block"), block(i).alias("value")) for i in range(len(BLOCKS))])))
    # the index is many times its items: its size before the expansion must not make it a broadcast
    met = looked.join(index.hint("merge"), ["n", "block", "value"])
    return met.filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius).select(
        "n", "content", "item_id").distinct()


def _row(docs: DataFrame) -> Column:
    """Names a row by its id and text, also where the id is null or repeated."""
    return F.xxhash64(docs["doc_id"], F.coalesce(docs["text"], F.lit("")))


def _matches(docs: DataFrame, items: DataFrame, similarity: float, radius: int) -> DataFrame:
    """(row, doc_id, item_id, similarity, start, n): all windows that match."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), _row(docs).alias("row"))
    table = materialize(_item_table(items), "items")
    sizes = [r[0] for r in table.select("size").distinct().collect()]    # at most SHINGLE values
    spread = table.select("size", "item_id", "n", F.posexplode("shingles").alias("offset", "hash"))
    windows = None
    for size in sorted(sizes):
        lookup = spread.filter(F.col("size") == size).select("hash", "n", "offset").distinct()
        part = _windows(docs, lookup, size)
        windows = part if windows is None else windows.union(part)
    if windows is None:
        kinds = dict(docs.dtypes) | dict(items.dtypes)
        return docs.sparkSession.createDataFrame(
            [], f"row long, doc_id {kinds['doc_id']}, item_id {kinds['item_id']}, similarity double, start int, n int")
    windows = materialize(windows.withColumn("content", F.xxhash64("shingles")), "windows")

    contents = windows.groupBy("n", "content").agg(F.first("shingles").alias("shingles"))
    weights = materialize(
        contents.select("n", "content", F.explode("shingles").alias("hash"))
        .groupBy("n", "content", "hash").agg(F.count(F.lit(1)).alias("weight")), "weights")
    item_weights = spread.groupBy("item_id", "n", "hash").agg(F.count(F.lit(1)).alias("item_weight"))
    window_fp = simhash(weights, ["n", "content"])
    item_fp = simhash(item_weights.withColumnRenamed("item_weight", "weight"), ["item_id", "n"])
    pairs = _candidates(window_fp, item_fp, radius)

    window_total = weights.groupBy("n", "content").agg(F.sum("weight").alias("total"))
    item_total = item_weights.groupBy("item_id").agg(F.sum("item_weight").alias("item_total"))
    common = (pairs.join(weights, ["n", "content"]).join(item_weights, ["item_id", "n", "hash"])
              .groupBy("n", "content", "item_id")
              .agg(F.sum(F.least("weight", "item_weight")).alias("common")))
    scored = (common.join(window_total, ["n", "content"]).join(item_total, "item_id")
              .select("n", "content", "item_id",
                      (F.col("common") / (F.col("total") + F.col("item_total") - F.col("common")))
                      .alias("similarity"))
              .filter(F.col("similarity") >= similarity))
    return windows.join(scored, ["n", "content"]).select("row", "doc_id", "item_id", "similarity", "start", "n")


def contaminated(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY,
                 radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, similarity, start, n): the best window of every
    document and benchmark item that match; `start` counts words from 0."""
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n")).alias("best")
    return (_matches(docs, items, similarity, radius).groupBy("doc_id", "item_id").agg(best)
            .select("doc_id", "item_id", F.col("best.similarity").alias("similarity"),
                    (-F.col("best.back")).cast("int").alias("start"), F.col("best.n").alias("n")))


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """`docs` without the rows that hold a benchmark item; other rows of their
    doc_id, or without one, stay."""
    found = _matches(docs, items, SIMILARITY, RADIUS).select(F.col("row").alias("__row")).distinct()
    return docs.join(found, _row(docs) == found["__row"], "left_anti")
