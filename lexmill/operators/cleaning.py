"""Corpus-level cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexmill.functions import patterns as P
from lexmill.functions.cleaning import clean_text
from lexmill.functions.tokenizers import tokenize_whitespace
from lexmill.operators.corpus import sample_n
from lexmill.plans.selection import SEED


def clean_corpus(df: DataFrame, text: str = "text", aggressive: bool = False,
                 min_len: int = 10) -> DataFrame:
    """Add `text_clean` and drop rows left with `min_len` characters or fewer.

    Text and test are unfolded from one array, so the cleaning chain runs once
    per row.  As a filter on the cleaned column, Catalyst would run the chain
    a second time below the layout shuffle, for the pushed-down predicate.
    """
    kept = F.filter(F.array(clean_text(F.col(text), aggressive)), lambda t: F.length(t) > min_len)
    return df.withColumn("text_clean", F.explode(kept))


def noise_audit(df: DataFrame, n: int = 200, seed: int = SEED, text: str = "text",
                key: str = "doc_id") -> DataFrame:
    """Noise found in a seeded sample, and what cleaning takes away."""
    sample = sample_n(df.select(key, text), n, seed, key)
    t, c = F.col(text), F.col("clean")
    rows = sample.withColumn("clean", clean_text(t)).select(
        F.regexp_count(t, F.lit(P.HTML_TAG)).alias("html"),
        F.regexp_count(t, F.lit(P.WEB_URL)).alias("url"),
        F.regexp_count(t, F.lit(P.HANDLE)).alias("handle"),
        F.regexp_count(t, F.lit(P.REPEATED_PUNCT)).alias("punct"),
        F.regexp_count(t, F.lit(P.EMOJI)).alias("emoji"),
        F.regexp_count(t, F.lit(P.EMAIL)).alias("email"),
        F.length(t).alias("before"), F.length(c).alias("after"),
        F.size(tokenize_whitespace(t)).alias("tokens_before"),
        F.size(tokenize_whitespace(c)).alias("tokens_after"))
    return rows.agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.sum("html").alias("html_tags_found"),
        F.sum("url").alias("urls_found"),
        F.sum("handle").alias("social_handles_found"),
        F.sum("punct").alias("repeated_punct_found"),
        F.sum("emoji").alias("emojis_found"),
        F.sum("email").alias("email_addresses_found"),
        F.avg("before").alias("avg_length_before"),
        F.avg("after").alias("avg_length_after"),
        F.avg("tokens_before").alias("avg_tokens_before"),
        F.avg("tokens_after").alias("avg_tokens_after"),
        F.sum(F.col("before") - F.col("after")).alias("total_chars_removed"),
        ((1 - F.avg("after") / F.avg("before")) * 100).alias("reduction_pct"))
