"""Tokenizing whole corpora, and the tokenizer and stop-word reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lexmill.functions import patterns as P
from lexmill.functions.tokenizers import TOKENIZERS, counted, removal_rate, remove_stopwords
from lexmill.functions.wordlists import NEGATION_WORDS, stopwords
from lexmill.plans.layout import by_document
from lexmill.session import materialize


def tokenize_corpus(df: DataFrame, tokenizer: str = "contractions",
                    text: str = "text_clean", out: str = "tokens") -> DataFrame:
    return df.withColumn(out, TOKENIZERS[tokenizer](F.col(text)))


def _ascii_words(tokens: Column) -> Column:
    return F.transform(F.filter(tokens, lambda t: t.rlike(P.ASCII_WORD)), F.lower)


def oov_rate(df: DataFrame, lexicon: DataFrame, key: str = "doc_id",
             tokens: str = "tokens", word: str = "word") -> DataFrame:
    """Per document, the share of ASCII words missing from `lexicon`.

    Words are counted inside their document before the join, so a frequent word is
    looked up once per document and no task holds the words of its documents.  The lexicon is written first, so its measured
    size decides whether it is broadcast and the words stay where they are.
    """
    docs = by_document(df.select(key, tokens), key)
    words = docs.select(key, F.inline_outer(counted(_ascii_words(F.col(tokens)), "w", "n")))
    known = materialize(lexicon.select(F.lower(word).alias("w")).distinct().withColumn("known", F.lit(True)), "lexicon")
    missed = F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(F.lit(0)))
    total = F.sum("n")
    return (words.join(known, "w", "left").groupBy(key)
            .agg(F.when(total > 0, missed / total).otherwise(F.lit(0.0)).alias("oov_rate")))


def token_stats(df: DataFrame, lexicon: DataFrame, tokenizers: Sequence[str] = ("contractions", "regex", "whitespace"),
                key: str = "doc_id", text: str = "text_clean") -> DataFrame:
    """Mean and population deviation of tokens per document, and mean share
    of unknown words, per tokenizer.  One pass carries all tokenizers; words are
    counted inside their document."""
    tagged = by_document(df.select(key, text), key).select(key, F.explode(F.array(*[
        F.struct(F.lit(name).alias("tokenizer"), TOKENIZERS[name](F.col(text)).alias("tokens"))
        for name in tokenizers])).alias("x")).select(key, "x.tokenizer", "x.tokens")
    words = tagged.select(key, "tokenizer", F.size("tokens").alias("len"),
                          F.inline_outer(counted(_ascii_words(F.col("tokens")), "w", "n")))
    known = materialize(lexicon.select(F.lower("word").alias("w")).distinct().withColumn("known", F.lit(True)), "lexicon")
    missed = F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(F.lit(0)))
    total = F.sum("n")
    per_doc = (words.join(known, "w", "left").groupBy(key, "tokenizer", "len")
               .agg(F.when(total > 0, missed / total).otherwise(F.lit(0.0)).alias("oov")))
    return per_doc.groupBy("tokenizer").agg(
        F.avg("len").alias("avg_tokens"), F.stddev_pop("len").alias("std_tokens"),
        F.avg("oov").alias("avg_oov"))


def contraction_accuracy(cases: DataFrame, word: str = "word",
                         tokenizers: Sequence[str] = ("contractions", "regex")) -> DataFrame:
    """Share of contractions that fall into two or more tokens."""
    return cases.agg(F.count(F.lit(1)).alias("n_cases"), *[
        F.avg((F.size(TOKENIZERS[t](F.col(word))) >= 2).cast("double")).alias(f"{t}_accuracy")
        for t in tokenizers])


def preservation_rate(text: Column, expected: Column, tokenizer: str = "contractions") -> Column:
    """Share of the distinct expected words present after tokenizing (per row)."""
    found = F.transform(TOKENIZERS[tokenizer](text), F.lower)
    wanted = F.size(F.array_distinct(expected))
    kept = F.size(F.array_intersect(expected, found))
    return F.when(wanted > 0, kept / wanted).otherwise(F.lit(0.0))


def removal_report(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Mean and population deviation of the removal rate, per list."""
    t = F.col(tokens)
    kinds = ("standard", "custom")
    rates = df.select(*[removal_rate(t, remove_stopwords(t, stopwords(k))).alias(k) for k in kinds])
    wide = rates.agg(*[f(k).alias(f"{name}_{k}") for k in kinds
                       for name, f in (("avg", F.avg), ("std", F.stddev_pop))])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("list"), F.lit(len(stopwords(k))).alias("list_size"),
                 F.col(f"avg_{k}").alias("avg_removal_rate"),
                 F.col(f"std_{k}").alias("std_removal_rate")) for k in kinds])).alias("r")).select("r.*")


def negation_incidence(df: DataFrame, words: Sequence[str] = NEGATION_WORDS,
                       tokens: str = "tokens") -> DataFrame:
    """Percentage of documents per class that contain each word."""
    low = df.select("label", F.transform(tokens, F.lower).alias("low"))
    wide = low.groupBy("label").agg(*[
        (F.avg(F.array_contains("low", w).cast("double")) * 100).alias(w) for w in words])
    pairs = F.explode(F.array(*[F.struct(F.lit(w).alias("word"), F.col(w).alias("pct")) for w in words]))
    return wide.select("label", pairs.alias("p")).select("p.word", "label", "p.pct")
