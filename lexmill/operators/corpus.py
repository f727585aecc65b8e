"""Labels, filters, validation, sampling, duplicates, balance, splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lexmill.functions.wordlists import FAKE_RATINGS, REAL_RATINGS
from lexmill.plans.layout import scalar
from lexmill.plans.selection import SEED, keep_smallest
from lexmill.session import materialize

# A column with more distinct values than this is no class label.
MAX_CLASSES = 10_000

# Rows of each label that a source gives to the corpus.
CORPUS_CAPS = {
    ("statements", "Real"): 2_000, ("statements", "Fake"): 2_000,
    ("titles", "Real"): 1_500, ("titles", "Fake"): 1_500,
    ("headlines", "Satire"): 3_000,
}


# --- projections and predicates -------------------------------------------

def rating_label(rating: Column) -> Column:
    """Six truth ratings to two classes, null for anything else."""
    return (F.when(rating.isin(*REAL_RATINGS), F.lit("Real"))
            .when(rating.isin(*FAKE_RATINGS), F.lit("Fake")))


def map_labels(df: DataFrame, col: str = "label", out: str = "mapped_label") -> DataFrame:
    return df.withColumn(out, rating_label(F.col(col)))


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def keep_flagged(df: DataFrame, flag: str = "is_sarcastic", label: str = "Satire") -> DataFrame:
    return df.filter(F.col(flag) == 1).withColumn("label", F.lit(label))


def conform(df: DataFrame, source: str, text: str, label: str,
            original: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Project any input to (text, label, source, original_label, keep…)."""
    return df.select(
        F.col(text).cast("string").alias("text"),
        F.col(label).alias("label"),
        F.lit(source).alias("source"),
        F.col(original or label).cast("string").alias("original_label"), *keep)


def drop_short_clean(df: DataFrame, min_len: int = 10, col: str = "text_clean") -> DataFrame:
    return df.filter(F.length(col) > min_len)


def keep_classes(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    return df.filter(F.col("label").isin(*labels))


def class_array(df: DataFrame, col: str = "label") -> Column:
    """The sorted distinct classes of a table, as a scalar subquery.  The plan
    fails where there are more than MAX_CLASSES: such a column is no class."""
    distinct = df.filter(F.col(col).isNotNull()).select(col).distinct().limit(MAX_CLASSES + 1)
    checked = F.when(F.size("c") <= MAX_CLASSES, F.col("c")).otherwise(
        F.raise_error(F.lit(f"more than {MAX_CLASSES} classes")))
    return scalar(distinct.agg(F.array_sort(F.collect_list(col)).alias("c")), checked)


def encode_labels(df: DataFrame, col: str = "label", out: str = "label_idx") -> DataFrame:
    """Alphabetical class index, without shuffling or joining the rows."""
    return df.withColumn(out, (F.array_position(class_array(df, col), F.col(col)) - 1).cast("int"))


def decode_labels(df: DataFrame, classes: Column, idx: str = "label_idx",
                  out: str = "label") -> DataFrame:
    return df.withColumn(out, F.get(classes, F.col(idx)))


def length_reason(text: Column, low: int = 10, high: int = 10_000) -> Column:
    """`too_short`, `too_long`, or null for an accepted text."""
    n = F.length(text)
    return (F.when(text.isNull() | (n < low), F.lit("too_short"))
            .when(n > high, F.lit("too_long")))


def validate_texts(df: DataFrame, low: int = 10, high: int = 10_000) -> DataFrame:
    reason = length_reason(F.col("text"), low, high)
    return df.withColumn("reason", reason).withColumn("accepted", F.col("reason").isNull())


def validate_batches(df: DataFrame, batch: str = "batch_id", idx: str = "idx",
                     max_size: int = 100, low: int = 10, high: int = 10_000,
                     headers: DataFrame | None = None) -> DataFrame:
    """One row per batch: size, first bad member, verdict.

    `headers` lists batch ids that may have no member at all.  Counts and
    minima combine before the shuffle, so one huge batch is no hot spot.
    """
    bad = length_reason(F.col("text"), low, high)
    out = df.groupBy(batch).agg(
        F.count(F.lit(1)).alias("size"),
        F.min(F.when(bad.isNotNull(), F.struct(F.col(idx).alias("i"), bad.alias("why")))).alias("bad"))
    if headers is not None:
        out = (headers.select(batch).distinct().join(out, batch, "left")
               .withColumn("size", F.coalesce("size", F.lit(0).cast("long"))))
    error = (F.when(F.col("size") < 1, F.lit("empty_batch"))
             .when(F.col("size") > max_size, F.lit("batch_too_large"))
             .otherwise(F.col("bad.why")))
    return out.select(batch, "size", F.col("bad.i").alias("first_bad"),
                      error.alias("error"), error.isNull().alias("accepted"))


def preview(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)


# --- set operations, sampling, duplicates ----------------------------------

def union_sources(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def sample_n(df: DataFrame, n: int, seed: int = SEED, key: str = "doc_id") -> DataFrame:
    """Exactly min(n, count) rows, chosen by seeded hash of the key."""
    whole = lambda sizes: sizes.withColumn("target", F.least("n", F.lit(n)))
    return keep_smallest(df, key, [], whole, seed)


def cap_per_group(df: DataFrame, groups: Sequence[str], caps: int | Mapping[tuple, int],
                  seed: int = SEED, key: str = "doc_id") -> DataFrame:
    """At most `cap` rows per group; a mapping gives caps for named groups
    and leaves all others whole."""
    groups = list(groups)

    def allot(sizes: DataFrame) -> DataFrame:
        if isinstance(caps, int):
            cap = F.lit(caps)
        else:
            cap = F.lit(None).cast("long")
            for names, limit in caps.items():
                names = names if isinstance(names, tuple) else (names,)
                same = reduce(lambda a, b: a & b, [F.col(g) == v for g, v in zip(groups, names)])
                cap = F.when(same, F.lit(limit)).otherwise(cap)
        return sizes.withColumn("target", F.least("n", F.coalesce(cap, "n")))

    return keep_smallest(df, key, groups, allot, seed)


def dedup_exact(df: DataFrame, priority: str | None = None, text: str = "text",
                key: str = "doc_id") -> DataFrame:
    """Keep the first row of every exact text: by priority, then by key.

    Only a digest of the text and the order columns are shuffled, and minima
    combine before the shuffle, so a text that fills a third of the table is
    still cheap.  The winners come back by their unique key.
    """
    order = F.struct(*([F.col(priority)] if priority else []), F.col(key))
    winners = (df.groupBy(F.sha2(F.col(text), 256).alias("digest"))
               .agg(F.min(order).alias("first")).select(F.col(f"first.{key}").alias(key)))
    return df.join(winners, key, "left_semi")


def assemble_corpus(parts: Mapping[str, DataFrame], caps: Mapping[tuple[str, str], int] = CORPUS_CAPS, method: str = "class_weighted",
                    threshold: float = 0.40, seed: int = SEED, key: str = "key") -> DataFrame:
    """One corpus of several conformed sources: rows without label or text go,
    each label of a source is cut to its cap, sources are put together, equal texts are kept
    once, and the classes are balanced.

    `caps` maps (source, label) to a number of rows; what it does not name stays
    whole.  `parts` names the sources; each has the columns of `conform` and a unique
    `key`, from which a doc_id unique in the corpus is made.  Of equal texts the
    smallest doc_id stays.
    """
    rows = [df.withColumn("doc_id", F.col(key) * len(parts) + i).drop(key) for i, df in enumerate(parts.values())]
    whole = drop_missing(union_sources(*rows), ["label", "text"])
    return balance(dedup_exact(cap_per_group(whole, ["source", "label"], caps, seed)), method, threshold, seed)


def duplicate_rate(df: DataFrame, text: str = "text", approximate: bool = False) -> DataFrame:
    """Rows, distinct texts and (rows − distinct) / rows."""
    distinct = (F.approx_count_distinct(text, 0.01) if approximate
                else F.count_distinct(F.sha2(F.col(text), 256)))
    out = df.agg(F.count(text).alias("n"), distinct.alias("n_distinct"))
    rate = F.when(F.col("n") > 0, (F.col("n") - F.col("n_distinct")) / F.col("n")).otherwise(F.lit(0.0))
    return out.withColumn("rate", rate)


# --- balance and splits -----------------------------------------------------

def class_distribution(df: DataFrame, col: str = "label") -> DataFrame:
    """Rows and percentage per value, for any number of values."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = scalar(df.agg(F.count(F.lit(1)).alias("n")), F.col("n"))
    return counts.withColumn("pct", F.col("n") * 100.0 / total)


def balance(df: DataFrame, method: str = "class_weighted", threshold: float = 0.40,
            seed: int = SEED, key: str = "doc_id") -> DataFrame:
    """Act only if the largest class holds more than `threshold` of the rows.

    `undersample` cuts every class to the smallest one; `class_weighted` adds
    N / (k · n_c).  A `sample_weight` column is always present.
    """
    everything = W.partitionBy()

    def imbalanced() -> Column:
        return F.max("n").over(everything) / F.sum("n").over(everything) > threshold

    if method == "undersample":
        def allot(sizes: DataFrame) -> DataFrame:
            cut = F.when(imbalanced(), F.min("n").over(everything)).otherwise(F.col("n"))
            return sizes.withColumn("target", cut)
        return keep_smallest(df, key, ["label"], allot, seed).withColumn("sample_weight", F.lit(1.0))
    if method == "class_weighted":
        counts = df.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
        counts = materialize(counts, "counts")
        whole = scalar(counts.agg(F.struct(
            F.sum("n").alias("n"), F.count("n").alias("k"), F.max("n").alias("most")).alias("s")), F.col("s"))
        weight = F.when(whole["most"] / whole["n"] > threshold, whole["n"] / (whole["k"] * F.col("n"))).otherwise(
            F.lit(1.0))
        weights = counts.select("label", weight.alias("sample_weight"))
        return df.join(weights, "label", "left").select(*df.columns, "sample_weight")
    raise ValueError(f"unknown balancing method: {method}")


def stratified_split(df: DataFrame, test_size: float | int = 0.2, seed: int = SEED,
                     key: str = "doc_id", flag: str = "is_test") -> DataFrame:
    """Flag an exact stratified test set.

    A share is first turned into ⌈share · N⌉ rows; those are shared out in
    proportion to the classes, the last rows going to the largest remainders
    (ties by class name).
    """
    everything = W.partitionBy()

    def allot(sizes: DataFrame) -> DataFrame:
        total = F.sum("n").over(everything)
        wanted = F.lit(test_size) if isinstance(test_size, int) else F.ceil(F.lit(test_size) * total)
        exact = F.col("n") * F.least(wanted, total) / total
        left = F.least(wanted, total) - F.sum(F.floor("exact")).over(everything)
        by_rest = W.partitionBy().orderBy((F.col("exact") - F.floor("exact")).desc(), "label")
        return (sizes.withColumn("exact", exact)
                .withColumn("extra", (F.row_number().over(by_rest) <= left).cast("long"))
                .withColumn("target", F.floor("exact") + F.col("extra")))

    return keep_smallest(df, key, ["label"], allot, seed, flag=flag)


def labelled(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with their class: good and clean is Real, toxic is Fake,
    the rest Satire."""
    label = (F.when(F.col("toxic") == 1, "Fake").when(F.col("quality") == 1, "Real")
             .otherwise("Satire"))
    return (documents.select("doc_id", "text", "source")
            .join(labels.select("doc_id", label.alias("label")), "doc_id"))
