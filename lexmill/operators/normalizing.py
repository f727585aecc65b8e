"""Normal forms, computed once per distinct word and joined back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lexmill.functions.cleaning import clean_text
from lexmill.functions.stemming import porter, snowball
from lexmill.functions.tokenizers import (TOKENIZERS, plural_rule, removed_words,
                                          remove_stopwords, tokenize_whitespace)
from lexmill.functions.wordlists import stopwords
from lexmill.plans.layout import by_document

METHODS = ("porter", "snowball", "lemma")

# Steps in the order they run.
STEPS = ("clean", "tokenize", "remove_stopwords", "normalize")


def distinct_words(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    return docs.select(F.explode(tokens).alias("word")).distinct()


def stem_vocab(words: DataFrame, method: str = "porter") -> DataFrame:
    """(word, norm) for a table of distinct words."""
    stem = {"porter": porter, "snowball": snowball}[method]
    return stem(words.select("word"), "word", "norm")


def lemma_vocab(words: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """(word, norm) from a dictionary (word, lemma[, pos]); a plural rule
    stands in for words it lacks.  Of several parts of speech the noun wins."""
    if dictionary is None:
        return words.select("word", plural_rule(F.col("word")).alias("norm"))
    pos = F.when(F.col("pos") == "n", 0).otherwise(1) if "pos" in dictionary.columns else F.lit(0)
    best = dictionary.groupBy("word").agg(F.min(F.struct(pos.alias("o"), F.col("lemma"))).alias("b"))
    return words.join(best, "word", "left").select(
        "word", F.coalesce("b.lemma", plural_rule(F.col("word"))).alias("norm"))


def normal_forms(words: DataFrame, method: str, dictionary: DataFrame | None = None) -> DataFrame:
    return lemma_vocab(words, dictionary) if method == "lemma" else stem_vocab(words, method)


def normalize_via_vocab(docs: DataFrame, mapping: DataFrame, tokens: str = "tokens",
                        key: str = "doc_id", out: str = "tokens_normalized",
                        carry: Sequence[str] = ()) -> DataFrame:
    """Replace tokens by their normal form, keeping order and unmapped tokens.

    Spark broadcasts a small mapping; a large one is joined by word, and
    adaptive execution splits the partitions of very frequent words.
    """
    laid = by_document(docs.select(key, *carry, tokens), key)
    rows = laid.select(key, *carry, F.posexplode_outer(tokens).alias("pos", "word"))
    form = F.coalesce("norm", "word")
    pairs = F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", form.alias("t"))))
    return (rows.join(mapping.select("word", "norm"), "word", "left").groupBy(key, *carry)
            .agg(F.transform(F.sort_array(pairs), lambda p: p["t"]).alias(out)))


def vocab_reduction(docs: DataFrame, methods: Sequence[str] = METHODS, tokens: str = "tokens",
                    dictionary: DataFrame | None = None) -> DataFrame:
    """Vocabulary size before and after each method, and the reduction in %."""
    words = distinct_words(docs, tokens)
    tables = []
    for method in methods:
        forms = normal_forms(words, method, dictionary).agg(
            F.count(F.lit(1)).alias("original_vocab"), F.count_distinct("norm").alias("new_vocab"))
        tables.append(forms.select(F.lit(method).alias("method"), "original_vocab", "new_vocab", (
            (1 - F.col("new_vocab") / F.col("original_vocab")) * 100).alias("reduction_pct")))
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def over_stemming(words: DataFrame, methods: Sequence[str] = METHODS) -> DataFrame:
    """Words cut below half their length or, by a stemmer, to their first
    three characters."""
    tables = []
    for method in methods:
        n, m = F.length("word"), F.length("norm")
        over = m < n * 0.5
        if method != "lemma":
            over = over | (F.col("norm") == F.substring("word", 1, 3))
        tables.append(normal_forms(words, method).agg(
            F.count(F.lit(1)).alias("n_terms"), F.sum(over.cast("long")).alias("over_stemmed"))
            .select(F.lit(method).alias("method"), "n_terms", "over_stemmed"))
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def preprocess(df: DataFrame, steps: Sequence[str] | None = None, text: str = "text") -> DataFrame:
    """Run chosen steps in their fixed order and report them.

    Adds tokens, removed_stopwords, processing_steps and token_count; all of
    it is one projection.  `normalize` applies the dictionary-free lemma rule.
    """
    chosen = [s for s in STEPS if steps is None or s in steps]
    unknown = set(steps or ()) - set(STEPS)
    if unknown:
        raise ValueError(f"unknown steps: {sorted(unknown)}")
    body: Column = clean_text(F.col(text)) if "clean" in chosen else F.col(text)
    tokenize = TOKENIZERS["contractions"] if "tokenize" in chosen else tokenize_whitespace
    df = df.withColumn("__all", tokenize(body))
    kept = F.col("__all")
    removed = F.lit(None).cast("array<string>")
    if "remove_stopwords" in chosen:
        kept = remove_stopwords(kept, stopwords("custom"))
        removed = removed_words(F.col("__all"), kept)
    if "normalize" in chosen:
        kept = F.transform(kept, plural_rule)
    out = df.withColumn("tokens", kept).withColumn(
        "removed_stopwords", F.coalesce(removed, F.array().cast("array<string>")))
    return (out.withColumn("processing_steps", F.array(*[F.lit(s) for s in chosen]).cast("array<string>"))
            .withColumn("token_count", F.size("tokens")).drop("__all"))
