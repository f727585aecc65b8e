"""N-gram language models per class.

Counts of all classes sit side by side in one row per n-gram, so scoring a
text under every class is one join, not one per class.  Contexts are the
space-joined words before the last one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lexmill.plans.layout import by_document
from lexmill.session import materialize

# Sentence markers, probability floor, discount.
START, END = "<s>", "</s>"
FLOOR = 1e-10
DISCOUNT = 0.75


def ngrams(docs: DataFrame, n: int, tokens: str = "tokens", key: str = "doc_id",
           carry: Sequence[str] = (), pads: int | None = None) -> DataFrame:
    """All n-grams of each document, padded with n − 1 start markers and one
    end marker: (key, carry…, context, word)."""
    pads = n - 1 if pads is None else pads
    laid = by_document(docs.select(key, *carry, tokens), key)
    padded = F.concat(F.array_repeat(F.lit(START), pads), F.col(tokens), F.array(F.lit(END)))
    rows = laid.select(key, *carry, padded.alias("p"))

    def gram(i: Column) -> Column:
        words = [F.get("p", i + j) for j in range(n)]
        context = F.concat_ws(" ", *words[:-1]) if n > 1 else F.lit("")
        return F.struct(context.alias("context"), words[-1].alias("word"))

    starts = F.sequence(F.lit(0), F.size("p") - n)
    some = F.size("p") >= n
    grams = F.when(some, F.transform(starts, gram))
    return rows.select(key, *carry, F.explode(grams).alias("g")).select(
        key, *carry, "g.context", "g.word")


def ngram_counts(docs: DataFrame, n: int, tokens: str = "tokens", key: str = "doc_id") -> DataFrame:
    """(label, context, word, c)."""
    return (ngrams(docs, n, tokens, key, ("label",)).groupBy("label", "context", "word")
            .agg(F.count(F.lit(1)).alias("c")))


def context_counts(counts: DataFrame) -> DataFrame:
    """(label, context, ctx, followers) from n-gram counts."""
    return counts.groupBy("label", "context").agg(
        F.sum("c").alias("ctx"), F.count(F.lit(1)).alias("followers"))


def class_stats(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(label, total_tokens, vocab_size): markers count in the vocabulary only."""
    words = (docs.select("label", F.explode(tokens).alias("word")).groupBy("label", "word")
             .agg(F.count(F.lit(1)).alias("c")))
    return words.groupBy("label").agg(F.sum("c").alias("total_tokens"),
                                      (F.count(F.lit(1)) + 2).alias("vocab_size"))


def unique_ngram_count(counts: DataFrame) -> DataFrame:
    return counts.groupBy("label").agg(F.count(F.lit(1)).alias("unique_ngrams"))


def top_ngrams(counts: DataFrame, k: int = 20) -> DataFrame:
    """Most frequent n-grams per class with their share of all n-grams.

    Class totals come from an aggregate joined to the k winners only.
    """
    totals = counts.groupBy("label").agg(F.sum("c").alias("total"))
    ngram = F.when(F.col("context") == "", F.col("word")).otherwise(F.concat_ws(" ", "context", "word"))
    order = W.partitionBy("label").orderBy(F.desc("c"), "ngram")
    top = (counts.select("label", ngram.alias("ngram"), "c")
           .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k))
    return top.join(totals, "label").select("label", "rank", "ngram", "c",
                                            (F.col("c") / F.col("total")).alias("p"))


def continuation_stats(docs: DataFrame, tokens: str = "tokens", pads: int = 1) -> DataFrame:
    """(label, side, token, n): distinct left contexts per word (`left`),
    distinct followers per context (`right`), all bigram types (`types`)."""
    pairs = (ngrams(docs, 2, tokens, carry=("label",), pads=pads)
             .groupBy("label", "context", "word").agg(F.lit(1).alias("one")))
    sides = pairs.select("label", F.explode(F.array(
        F.struct(F.lit("left").alias("side"), F.col("word").alias("token")),
        F.struct(F.lit("right").alias("side"), F.col("context").alias("token")),
        F.struct(F.lit("types").alias("side"), F.lit("").alias("token")))).alias("s"))
    return (sides.select("label", "s.side", "s.token").groupBy("label", "side", "token")
            .agg(F.count(F.lit(1)).alias("n")))


@dataclass(frozen=True)
class NgramModel:
    """Fitted tables of one order; one column per class in each."""

    n: int
    smoothing: str
    classes: tuple[str, ...]
    counts: DataFrame                  # context, word, c_<class>
    contexts: DataFrame                # context, ctx_<class>, fol_<class>
    totals: Column                     # scalar struct: T_, V_, types_ per class
    continuations: DataFrame | None    # word, cont_<class>
    discount: float = DISCOUNT
    mode: str = "as_implemented"


def _per_class(classes: Sequence[str]) -> list[Column]:
    return [F.sum((F.col("label") == c).cast("long")).alias(f"c_{c}") for c in classes]


def trigram_table(docs: DataFrame, classes: Sequence[str] = ("Real", "Fake"), tokens: str = "tokens",
                  key: str = "doc_id") -> DataFrame:
    """Trigram counts per class, (context, word, c_<class>…), written once.  The
    counts of all lower orders are folds of this table, so models of several
    orders read the texts once."""
    docs = docs.filter(F.col("label").isin(*classes))
    return materialize(ngrams(docs, 3, tokens, key, ("label",))
                       .groupBy("context", "word").agg(*_per_class(classes)), "ngrams")


def _folded(trigrams: DataFrame, order: int, classes: Sequence[str], second_start: bool = False) -> DataFrame:
    """Counts of a lower order.  With `second_start`, bigrams as two start
    markers give them: one more for each document, between the markers."""
    if order == 3:
        return trigrams
    sums = [F.sum(f"c_{c}").alias(f"c_{c}") for c in classes]
    context = F.substring_index("context", " ", -1) if order == 2 else F.lit("")
    counts = trigrams.groupBy(context.alias("context"), "word").agg(*sums)
    if second_start:
        ends = trigrams.filter(F.col("word") == END).agg(*sums)
        starts = ends.select(F.lit(START).alias("context"), F.lit(START).alias("word"), *[f"c_{c}" for c in classes])
        counts = counts.union(starts.filter(F.greatest(*[F.coalesce(f"c_{c}", F.lit(0)) for c in classes]) > 0)
                              if len(classes) > 1 else starts.filter(F.col(f"c_{classes[0]}") > 0))
    return counts


def fit_ngram_model(docs: DataFrame, n: int, smoothing: str = "laplace",
                    classes: Sequence[str] = ("Real", "Fake"), tokens: str = "tokens",
                    key: str = "doc_id", discount: float = DISCOUNT,
                    mode: str = "as_implemented", trigrams: DataFrame | None = None) -> NgramModel:
    """Fit per-class models of order n.

    `smoothing` is none, laplace or kneser_ney.  For kneser_ney with n = 3,
    mode "as_implemented" gives every seen context a follower count of 1 and
    "formula" uses the real count.  All tables are folds of the trigram counts,
    which may be given (`trigram_table`); orders above three count anew.
    """
    if smoothing not in ("none", "laplace", "kneser_ney"):
        raise ValueError(f"unknown smoothing: {smoothing}")
    docs = docs.filter(F.col("label").isin(*classes))
    if n <= 3:
        trigrams = trigram_table(docs, classes, tokens, key) if trigrams is None else trigrams

    def table(order: int, pads: int) -> DataFrame:
        if n <= 3:
            return _folded(trigrams, order, classes, order == 2 and pads == 2)
        return (ngrams(docs, order, tokens, key, ("label",), pads)
                .groupBy("context", "word").agg(*_per_class(classes)))

    counts = table(n, n - 1)
    counts = materialize(counts, "ngrams") if n != 3 else counts
    contexts = counts.groupBy("context").agg(
        *[F.sum(f"c_{c}").alias(f"ctx_{c}") for c in classes],
        *[F.sum((F.col(f"c_{c}") > 0).cast("long")).alias(f"fol_{c}") for c in classes])
    words = counts if n == 1 else table(1, 0)
    words = words.filter(F.col("word") != END)
    sizes = words.agg(F.struct(
        *[F.coalesce(F.sum(f"c_{c}"), F.lit(0)).alias(f"T_{c}") for c in classes],
        *[(F.coalesce(F.sum((F.col(f"c_{c}") > 0).cast("long")), F.lit(0)) + 2).alias(f"V_{c}")
          for c in classes]).alias("s"))
    continuations, types = None, [F.lit(0).cast("long").alias(f"types_{c}") for c in classes]
    if smoothing == "kneser_ney":
        pairs = counts if n == 2 else table(2, n - 1)
        continuations = pairs.groupBy("word").agg(
            *[F.sum((F.col(f"c_{c}") > 0).cast("long")).alias(f"cont_{c}") for c in classes])
        all_types = continuations.agg(F.struct(
            *[F.sum(f"cont_{c}").alias(f"types_{c}") for c in classes]).alias("s")).scalar()
        types = [all_types[f"types_{c}"].alias(f"types_{c}") for c in classes]
    size = sizes.scalar()
    totals = F.struct(*[size[f"{x}_{c}"].alias(f"{x}_{c}") for x in "TV" for c in classes], *types)
    return NgramModel(n, smoothing, tuple(classes), counts, contexts, totals,
                      continuations, discount, mode)


def _probability(m: NgramModel, c: str) -> Column:
    """P(word | context) under class c, floored as the smoothing asks."""
    zero, floor = F.lit(0), F.lit(FLOOR)
    count = F.coalesce(F.col(f"c_{c}"), zero).cast("double")
    total, size = F.col(f"t.T_{c}").cast("double"), F.col(f"t.V_{c}").cast("double")
    if m.n == 1:
        if m.smoothing == "laplace":
            return (count + 1) / (total + size)
        return F.when(count > 0, count / total).otherwise(floor)
    ctx = F.coalesce(F.col(f"ctx_{c}"), zero).cast("double")
    if m.smoothing == "laplace":
        return (count + 1) / (ctx + size)
    if m.smoothing == "none":
        return F.when(count > 0, count / ctx).otherwise(floor)
    types = F.col(f"t.types_{c}").cast("double")
    cont = F.greatest(F.coalesce(F.col(f"cont_{c}"), zero).cast("double"), floor)
    p_cont = F.when(types > 0, cont / types).otherwise(floor)
    followers = F.coalesce(F.col(f"fol_{c}"), zero).cast("double")
    if m.n > 2 and m.mode == "as_implemented":
        followers = F.lit(1.0)
    seen = (F.greatest(count - m.discount, F.lit(0.0)) + m.discount * followers * p_cont) / ctx
    return F.greatest(F.when(ctx > 0, seen).otherwise(p_cont), floor)


def lm_prob(grams: DataFrame, model: NgramModel) -> DataFrame:
    """Add p_<class> to any table with `context` and `word` columns.

    Left joins on high-cardinality keys; hot contexts are skewed join
    partitions, which adaptive execution splits.
    """
    rows = grams.join(model.counts, ["context", "word"], "left")
    if model.n > 1:
        rows = rows.join(model.contexts, "context", "left")
    if model.smoothing == "kneser_ney" and model.n > 1:
        rows = rows.join(model.continuations, "word", "left")
    rows = rows.withColumn("t", model.totals)
    return rows.select(*grams.columns,
                       *[_probability(model, c).alias(f"p_{c}") for c in model.classes])


def document_trigrams(docs: DataFrame, tokens: str = "tokens", key: str = "doc_id",
                      carry: Sequence[str] = ()) -> DataFrame:
    """(key, carry…, context, word, m): the trigrams of each document with their
    multiplicity, written by document; lower orders are folds of them."""
    return materialize(ngrams(docs, 3, tokens, key, carry).groupBy(key, *carry, "context", "word").agg(
        F.count(F.lit(1)).alias("m")), "grams", key)


def perplexity(docs: DataFrame, model: NgramModel, tokens: str = "tokens", key: str = "doc_id",
               carry: Sequence[str] = (), grams: DataFrame | None = None) -> DataFrame:
    """(key, carry…, pp_<class>…): exp of the mean negative log probability.

    Every distinct n-gram of all documents is looked up once, however many
    documents hold it, so the sentence markers are no hot keys; its probabilities
    then come back to the documents in one join.  `grams` may hold the trigrams
    of the documents (`document_trigrams`).
    """
    if model.n <= 3:
        grams = document_trigrams(docs, tokens, key, carry) if grams is None else grams
        if model.n < 3:
            context = F.substring_index("context", " ", -1) if model.n == 2 else F.lit("")
            grams = grams.groupBy(key, *carry, context.alias("context"), "word").agg(F.sum("m").alias("m"))
    else:
        grams = (ngrams(docs, model.n, tokens, key, carry)
                 .groupBy(key, *carry, "context", "word").agg(F.count(F.lit(1)).alias("m")))
    known = materialize(lm_prob(grams.select("context", "word").distinct(), model), "probabilities")
    scored = grams.join(known, ["context", "word"])
    return scored.groupBy(key, *carry).agg(*[
        F.exp(-F.sum(F.col("m") * F.ln(f"p_{c}")) / F.sum("m")).alias(f"pp_{c}")
        for c in model.classes])


def classify_by_perplexity(scores: DataFrame, classes: Sequence[str] = ("Real", "Fake")) -> DataFrame:
    """Add `prediction`: the class of lowest perplexity, ties to the earlier one."""
    columns = [F.col(f"pp_{c}") for c in classes]
    low = F.least(*columns) if len(columns) > 1 else columns[0]
    pick = F.lit(None).cast("string")
    for c in reversed(classes):
        pick = F.when(F.col(f"pp_{c}") <= low, F.lit(c)).otherwise(pick)
    return scores.withColumn("prediction", pick)
