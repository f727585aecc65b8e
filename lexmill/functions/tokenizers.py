"""Tokenizers and token-array functions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from lexmill.functions import patterns as P
from lexmill.functions.cleaning import once, replace_where, squeeze_space

# Fixed rules of the word splitter, applied in this order to the text padded
# with one space on each side.  Replacements use $n for group n.  One of the marks
# stands in every match; a rule without marks is applied to every text.
SPLIT_RULES = (
    (r"([«“‘„»”’]|`+)", " $1 ", tuple("«“‘„»”’`")),     # typographic quotes
    (r'([ (\[{<])"', "$1 `` ", ('"',)),                 # opening double quote
    (r"\"|''", " '' ", ('"', "''")),                    # closing double quote
    (r"(\.{2,}|--)", " $1 ", ("..", "--")),             # ellipsis, double dash
    (r"([\]\[(){}<>;@#$%&?!*])", " $1 ", ()),           # stand-alone marks
    (r"([:,])([^\p{Nd}])", " $1 $2", ()),               # not inside numbers
    (r"\.(?<=(?:[\p{L}\p{N}_]{2}|[^\p{L}\p{N}_. ])\.)([\])}>\"'»”’]*) ", " . $1 ", ()),
)
# Fixed rules for words written together, applied after every space is doubled
# so that neighbouring words do not share one; with an apostrophe, and without.
CLITIC_RULES = (
    # Each pattern starts with a character that is rare in text and looks back
    # from there, so that ordinary letters are passed over quickly.
    (r"'(?<=[^' ]')(?i:s|m|d|ll|re|ve)? ", " $0"),
    (r"[nN](?<=[^' ].)'[tT] ", " $0"),
    (r" ((?i:d))((?i:'ye)) ", " $1 $2 "),
    (r" ((?i:more))((?i:'n)) ", " $1 $2 "),
    (r" ((?i:'t))((?i:is|was)) ", " $1 $2 "),
)
JOINED_RULES = (
    (r" ((?i:can))((?i:not)) ", " $1 $2 "),
    (r" ((?i:gim|lem))((?i:me)) ", " $1 $2 "),
    (r" ((?i:gon|wan))((?i:na)) ", " $1 $2 "),
    (r" ((?i:got))((?i:ta)) ", " $1 $2 "),
)
JOINED_WORDS = ("cannot", "gimme", "lemme", "gonna", "wanna", "gotta")


def tokenize_regex(col: Column) -> Column:
    """Abbreviations, words with inner hyphens or apostrophes, punctuation."""
    return F.regexp_extract_all(col, F.lit(P.TEXT_TOKEN), F.lit(0))


def tokenize_contractions(col: Column) -> Column:
    """Treebank-style words: `don't` becomes `do`, `n't`."""
    col = F.concat(F.lit(" "), squeeze_space(col), F.lit(" "))
    for pattern, replacement, marks in SPLIT_RULES:
        col = (replace_where(col, marks, pattern, replacement) if marks
               else F.regexp_replace(col, pattern, replacement))
    # only plain spaces are left; every run of them becomes two
    col = F.concat(F.lit("  "), F.regexp_replace(F.trim(col), " +", "  "), F.lit("  "))
    col = once(col, lambda t: F.when(t.contains("'"), _apply(t, CLITIC_RULES)).otherwise(t))
    joined = lambda t: once(F.lower(t), lambda low: reduce(
        or_, [low.contains(w) for w in JOINED_WORDS]))
    col = once(col, lambda t: F.when(joined(t), _apply(t, JOINED_RULES)).otherwise(t))
    return _words(F.split(F.trim(col), " +"))


def tokenize_whitespace(col: Column) -> Column:
    return _words(F.split(squeeze_space(col), " "))


def tokenize_vectorizer(col: Column) -> Column:
    """The vectorizers' own tokens: lowercase words of two or more characters."""
    return F.regexp_extract_all(F.lower(col), F.lit(P.VECTORIZER_TOKEN), F.lit(0))


def _apply(col: Column, rules: Iterable[tuple[str, str]]) -> Column:
    for pattern, replacement in rules:
        col = F.regexp_replace(col, pattern, replacement)
    return col


def _words(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: t != "")


TOKENIZERS = {
    "contractions": tokenize_contractions,
    "regex": tokenize_regex,
    "whitespace": tokenize_whitespace,
    "vectorizer": tokenize_vectorizer,
}


def remove_stopwords(tokens: Column, words: Iterable[str]) -> Column:
    """Keep tokens whose lowercase form is not listed (a hash-set test)."""
    listed = list(words)
    return F.filter(tokens, lambda t: ~F.lower(t).isin(listed))


def counted(tokens: Column, term: str = "term", n: str = "tf") -> Column:
    """The distinct tokens of one array with their counts, as (term, n) structs; a
    missing token counts 0.  The array is sorted and cut where neighbours differ."""
    def runs(s: Column) -> Column:
        last = F.filter(F.sequence(F.lit(1), F.size(s)),
                        lambda i: (i == F.size(s)) | ~F.get(s, i - 1).eqNullSafe(F.get(s, i)))
        return once(last, lambda ends: F.transform(ends, lambda e, j: F.struct(
            F.get(s, e - 1).alias(term),
            F.when(F.get(s, e - 1).isNull(), F.lit(0))
            .otherwise(e - F.coalesce(F.get(ends, j - 1), F.lit(0))).cast("long").alias(n))))

    return once(F.sort_array(tokens), lambda s: F.when(F.size(s) > 0, runs(s)))


def removal_rate(before: Column, after: Column) -> Column:
    n = F.size(before)
    return F.when(n > 0, F.lit(1.0) - F.size(after) / n).otherwise(F.lit(0.0))


def removed_words(before: Column, after: Column) -> Column:
    """Sorted lowercase words present before and absent after."""
    low = lambda tokens: F.array_distinct(F.transform(tokens, F.lower))
    return F.array_sort(F.array_except(low(before), low(after)))


def min_token_length(tokens: Column, k: int) -> Column:
    return F.filter(tokens, lambda t: F.length(t) >= k)


def marker_share(tokens: Column, markers: Iterable[str]) -> Column:
    """Share of tokens found in a marker list, 0 for no tokens."""
    listed = list(markers)
    hits = F.size(F.filter(tokens, lambda t: t.isin(listed)))
    return F.when(F.size(tokens) > 0, hits / F.size(tokens)).otherwise(F.lit(0.0))


def plural_rule(word: Column) -> Column:
    """Fallback lemma of a noun where no dictionary is supplied."""
    # without an s no rule applies; most words need no pattern
    return (F.when((F.length(word) <= 3) | ~word.contains("s"), word)
            .when(word.endswith("ies") & (F.length(word) > 4),
                  F.concat(_chop(word, 3), F.lit("y")))
            .when(word.rlike("(ss|sh|ch|x|z)es$"), _chop(word, 2))
            .when(word.rlike("[^sui]s$"), _chop(word, 1))
            .otherwise(word))


def _chop(word: Column, n: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)
