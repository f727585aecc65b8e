"""Exact seeded selection without sorting a group in one task.

Picking exactly n rows of a class with `row_number() over (partition by class)`
sends a whole class to one task.  Here each row gets a pseudo-random hash of its
key, a histogram over hash prefixes locates the prefix that holds the n-th
smallest hash, and only the rows of that one prefix are ranked.  The result is
one cut-off hash per group; keeping a row is then one comparison with its group's
cut-off.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lexmill.session import materialize

SEED = 42
_PREFIX = 4  # hex digits of the histogram bucket: 65,536 buckets per group


def seeded_hash(key: str | Column, seed: int = SEED) -> Column:
    """md5 of `seed:key`, an order any engine reproduces."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def _group_key(groups: list[str]) -> Column:
    parts = [F.coalesce(F.col(g).cast("string"), F.lit("\u0000")) for g in groups]
    return F.concat_ws("\u0001", *parts) if parts else F.lit("")


def keep_smallest(df: DataFrame, key: str, groups: list[str],
                  allot: Callable[[DataFrame], DataFrame],
                  seed: int = SEED, flag: str | None = None) -> DataFrame:
    """Keep exactly `target` rows of every group, those with the smallest hash.

    `key` must be unique.  `allot` turns the table (groups…, n) of group sizes
    into (groups…, target).  With `flag`, all rows are kept and the choice
    becomes a boolean column.

    Two small jobs over key and group columns find the cut-offs while the plan
    is built; they come back as a written table whose measured size decides how
    it is joined.
    """
    hashed = df.select(_group_key(groups).alias("__g"), *groups,
                       seeded_hash(key, seed).alias("__h"))
    bucket = F.substring("__h", 1, _PREFIX)
    hist = hashed.groupBy("__g", *groups, bucket.alias("__b")).agg(F.count(F.lit(1)).alias("n"))
    sizes = hist.groupBy("__g", *groups).agg(F.sum("n").alias("n"))
    upto = W.partitionBy("__g").orderBy("__b")
    edge = (hist.join(allot(sizes).select("__g", "target"), "__g")
            .withColumn("__cum", F.sum("n").over(upto))
            .filter((F.col("__cum") >= F.col("target"))
                    & (F.col("__cum") - F.col("n") < F.col("target")))
            .select("__g", "__b", (F.col("target") - F.col("__cum") + F.col("n")).alias("__need")))
    near = hashed.withColumn("__b", bucket).join(materialize(edge, "edges"), ["__g", "__b"])
    cut = (near.withColumn("__r", F.row_number().over(W.partitionBy("__g").orderBy("__h")))
           .filter(F.col("__r") == F.col("__need")).select("__g", F.col("__h").alias("__cut")))
    out = df.withColumn("__g", _group_key(groups)).join(materialize(cut, "cuts"), "__g", "left")
    limit = F.col("__cut")
    chosen = F.coalesce(seeded_hash(key, seed) <= limit, F.lit(False))
    out = out.withColumn(flag, chosen) if flag else out.filter(chosen)
    return out.drop("__g", "__cut")
