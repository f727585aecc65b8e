"""Text cleaning as column expressions: one projection, no Python workers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from lexmill.functions import patterns as P


def _blank(col: Column, pattern: str) -> Column:
    return F.regexp_replace(col, pattern, " ")


def once(col: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once, however often `use` names it."""
    return F.get(F.transform(F.array(col), use), 0)


def replace_where(col: Column, marks: Sequence[str], pattern: str, by: str) -> Column:
    """`regexp_replace` for texts that hold one of `marks`, one of which stands in
    every match; other texts are passed over by a byte search."""
    held = lambda t: reduce(or_, [t.contains(m) for m in marks])
    return once(col, lambda t: F.when(held(t), F.regexp_replace(t, pattern, by)).otherwise(t))


def strip_html(col: Column) -> Column:
    return replace_where(col, ["<"], P.HTML_TAG, " ")


def strip_urls(col: Column) -> Column:
    return replace_where(col, ["://", "www."], P.URL, " ")


def strip_emails(col: Column) -> Column:
    return replace_where(col, ["@"], P.EMAIL, " ")


def strip_handles(col: Column) -> Column:
    return replace_where(replace_where(col, ["@"], P.MENTION, " "), ["#"], P.HASHTAG, " ")


def strip_emoji(col: Column, strict: bool = False) -> Column:
    """The default class also covers CJK and every astral character;
    `strict` narrows it to the emoji blocks."""
    pattern = P.EMOJI_STRICT if strict else P.EMOJI
    return once(col, lambda t: F.when(F.octet_length(t) > F.length(t), _blank(t, pattern)).otherwise(t))


def squeeze_punct(col: Column) -> Column:
    col = replace_where(col, ["!!", "??", ".."], P.REPEATED_PUNCT, "$1")
    return replace_where(col, ["--"], P.DASHES, "—")


def mask_numbers(col: Column) -> Column:
    col = F.regexp_replace(col, P.LONG_NUMBER, " NUM ")
    col = F.regexp_replace(col, P.MONEY, " MONEY ")
    return F.regexp_replace(col, P.PERCENT, " PERCENT ")


def strip_specials(col: Column) -> Column:
    return _blank(col, P.SPECIAL)


def fold_case(col: Column) -> Column:
    return F.lower(col)


def squeeze_space(col: Column) -> Column:
    return F.trim(F.regexp_replace(col, P.UNICODE + P.SPACE + "+", " "))


def clean_text(col: Column, aggressive: bool = False, strict_emoji: bool = False) -> Column:
    """All steps in their fixed order; a missing text becomes empty."""
    col = F.coalesce(col.cast("string"), F.lit(""))
    col = strip_handles(strip_emails(strip_urls(strip_html(col))))
    col = squeeze_punct(strip_emoji(col, strict_emoji))
    if aggressive:
        col = strip_specials(mask_numbers(col))
    return squeeze_space(fold_case(col))
