"""Packing documents into padded batches with optimal length buckets.

1. Tokens of each document: words of the text, unless a column holds the counts.
2. The global histogram of lengths.  Lengths up to 1,024 have a bin each, longer
   ones 512 bins an octave, so the histogram has at most FINE + 512 x 53 bins
   whatever the input; each bin keeps count, sum and largest length, so padding
   is counted exactly.
3. Dynamic programming over the histogram picks the bucket boundaries of least
   padding: best[b][j] = min over i of best[b-1][i] + padding of bins i..j in one
   bucket.  The padding is linear in the bucket's length, so each row of the
   table is a lower envelope of lines and takes one pass over the bins.
4. Documents are numbered inside their bucket without a sort in one task: a hash
   spreads a bucket over SLOTS slots, slot sizes give the offsets (a table of at
   most buckets x SLOTS rows), and each slot is numbered on its own.  A batch of
   a bucket holds as many documents as the token budget pays for at the bucket's
   length; all batches but a bucket's last are full.

Cases: null and empty texts have no tokens and sit in the shortest bucket; a
document longer than the budget makes a batch of its own; with fewer distinct
lengths than buckets there is one bucket a length and no padding; equal hashes
are ordered by doc_id, repeated rows each get a place; rows without a doc_id are
spread over the slots by their position in the written table of lengths, so that
many of them make no large slot, and which of them gets which place depends on the
partitioning; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lexmill.llm.shared import materialize

BUCKETS = 16
BUDGET = 65_536
FINE = 1_024
SLOTS = 2_048


def token_count(text: str | Column) -> Column:
    """Number of maximal runs without ASCII white space."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def length_bin(n: Column) -> Column:
    """Bin of a length: the length itself up to FINE, then its ten leading bits."""
    bits = F.length(F.bin(n))
    step = F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(bits - 10, F.lit(0)))
    return F.when(n <= FINE, n).otherwise((n / step).cast("long") * step)


def optimal_boundaries(bins: list[tuple[int, int, int]], buckets: int = BUCKETS) -> list[int]:
    """Upper lengths of the buckets of least padding, for bins (largest length,
    count, sum of lengths) in ascending order."""
    m = len(bins)
    if m <= buckets:
        return [b[0] for b in bins]
    counts, sums = [0], [0]
    for _, count, total in bins:
        counts.append(counts[-1] + count)
        sums.append(sums[-1] + total)
    best: list[float] = [0.0] + [float("inf")] * m
    choice: list[list[int]] = []
    for _ in range(buckets):
        # best'[j] = min_i (best[i] + sums[i] - length_j counts[i]) + length_j counts[j] - sums[j]
        hull: list[int] = []
        row, chosen, front = [0.0] + [float("inf")] * m, [0] * (m + 1), 0

        def height(i):
            return best[i] + sums[i]

        for j in range(1, m + 1):
            i = j - 1
            if best[i] < float("inf"):
                while len(hull) - front >= 2:
                    a, b = hull[-2], hull[-1]
                    # b lies above the envelope of a and i
                    if (height(b) - height(a)) * (counts[i] - counts[b]) >= (
                            height(i) - height(b)) * (counts[b] - counts[a]):
                        hull.pop()
                    else:
                        break
                hull.append(i)
            length = bins[j - 1][0]
            while len(hull) - front >= 2 and height(hull[front + 1]) - length * counts[hull[front + 1]] <= (
                    height(hull[front]) - length * counts[hull[front]]):
                front += 1
            if len(hull) > front:
                i = hull[front]
                row[j] = height(i) - length * counts[i] + length * counts[j] - sums[j]
                chosen[j] = i
        row[0] = float("inf")
        choice.append(chosen)
        best = row
    cuts, j = [], m
    for chosen in reversed(choice):
        cuts.append(bins[j - 1][0])
        j = chosen[j]
    return cuts[::-1]


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, tokens: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, bucket, bucket_length, batch, place): the batch of
    every row of `docs` and its place in it."""
    count = F.coalesce(F.col(tokens).cast("long"), F.lit(0)) if tokens else token_count("text")
    at = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    rows = materialize(docs.select("doc_id", count.alias("n_tokens"), at.alias("at")), "lengths")
    histogram = rows.groupBy(length_bin(F.col("n_tokens")).alias("bin")).agg(
        F.max("n_tokens").alias("length"), F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("total"))
    bins = [(r["length"], r["n"], r["total"]) for r in histogram.orderBy("bin").collect()]   # bounded, see above
    cuts = optimal_boundaries(bins, buckets) or [0]

    bucket = F.lit(len(cuts) - 1)
    for i in reversed(range(len(cuts) - 1)):
        bucket = F.when(F.col("n_tokens") <= cuts[i], F.lit(i)).otherwise(bucket)
    length = F.element_at(F.array(*[F.lit(c).cast("long") for c in cuts]), F.col("bucket") + 1)
    order = F.xxhash64("doc_id", "at", F.lit("packing"))
    placed = rows.withColumn("bucket", bucket).withColumn("hash", order).withColumn(
        "slot", F.pmod("hash", F.lit(SLOTS)))
    sizes = placed.groupBy("bucket", "slot").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("bucket").orderBy("slot")) - F.col("n")
    offsets = sizes.select("bucket", "slot", before.alias("before"))
    inside = F.row_number().over(W.partitionBy("bucket", "slot").orderBy("hash", "doc_id", "n_tokens"))
    numbered = placed.withColumn("inside", inside).join(F.broadcast(offsets), ["bucket", "slot"])
    room = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("bucket_length"), F.lit(1))))
    at = F.col("before") + F.col("inside") - 1
    return (numbered.withColumn("bucket_length", length).withColumn("room", room.cast("long"))
            .select("doc_id", "n_tokens", "bucket", "bucket_length",
                    F.floor(at / F.col("room")).cast("long").alias("batch"),
                    F.pmod(at, F.col("room")).cast("long").alias("place")))
