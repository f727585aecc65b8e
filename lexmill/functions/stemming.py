"""Porter and Snowball English stems as staged projections.

Both published algorithms are suffix-rule chains, so they run as built-in
expressions over a table of distinct words; no Python worker is involved.  Every
step is its own projection, which keeps expressions from multiplying.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

Condition = Callable[[Column], Column]
Rule = tuple[str, str, Condition]


def _cut(word: Column, n: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def _first_rule(word: Column, rules: Sequence[Rule], otherwise: Column | None = None) -> Column:
    """Apply the first rule whose suffix fits; a failed condition stops the search."""
    out = None
    for suffix, replacement, condition in rules:
        stem = _cut(word, len(suffix))
        result = F.when(condition(stem), F.concat(stem, F.lit(replacement))).otherwise(word)
        out = F.when(word.endswith(suffix), result) if out is None else out.when(word.endswith(suffix), result)
    return out.otherwise(word if otherwise is None else otherwise)


def _always(stem: Column) -> Column:
    return F.lit(True)


def _stages(df: DataFrame, word: str, steps: Sequence[Callable[[Column], Column]]) -> DataFrame:
    for step in steps:
        df = df.withColumn(word, step(F.col(word)))
    return df


# --- Porter -------------------------------------------------------------------

# Consonant and vowel runs, and the measures built from them.
# A leading y is written Y, because it is a consonant there.
_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_M0 = f"^({_C})?{_V}{_C}"
_M1 = f"^({_C})?{_V}{_C}({_V})?$"
_M2 = f"^({_C})?{_V}{_C}{_V}{_C}"
_HAS_VOWEL = f"^({_C})?[aeiouy]"
_CVC = f"(^{_C}[aeiouy][^aeiouwxy]$)|(^[aeiou][^aeiou]$)"

# Words that do not follow the rules.
PORTER_IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# Suffix tables of steps 2, 3 and 4.
PORTER_STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
)
PORTER_STEP3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""),
)
PORTER_STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)


def _m(pattern: str) -> Condition:
    return lambda stem: stem.rlike(pattern)


def _porter_plural(w: Column) -> Column:
    return (F.when(w.endswith("ies") & (F.length(w) == 4), _cut(w, 1))
            .when(w.endswith("sses") | w.endswith("ies"), _cut(w, 2))
            .when(w.endswith("s") & ~w.endswith("ss"), _cut(w, 1)).otherwise(w))


def _porter_past(w: Column) -> Column:
    """Mark a removed -ed or -ing with a trailing `+` for the next step."""
    bare = (F.when(w.endswith("ed"), _cut(w, 2)).when(w.endswith("ing"), _cut(w, 3)))
    return (F.when(w.endswith("ied"), F.when(F.length(w) == 4, _cut(w, 1)).otherwise(_cut(w, 2)))
            .when(w.endswith("eed"), F.when(_cut(w, 3).rlike(_M0), _cut(w, 1)).otherwise(w))
            .when(bare.rlike(_HAS_VOWEL), F.concat(bare, F.lit("+"))).otherwise(w))


def _porter_repair(w: Column) -> Column:
    s = _cut(w, 1)
    return (F.when(~w.endswith("+"), w)
            .when(s.rlike("(at|bl|iz)$"), F.concat(s, F.lit("e")))
            .when(s.rlike(r"([^aeiouylsz])\1$"), _cut(s, 1))
            .when(s.rlike(_M1) & s.rlike(_CVC), F.concat(s, F.lit("e")))
            .otherwise(s))


def _porter_y(w: Column) -> Column:
    return F.when(w.rlike("..+[^aeiou]y$|.[^aeiouy]y$"), F.concat(_cut(w, 1), F.lit("i"))).otherwise(w)


def _porter_2(w: Column) -> Column:
    rules = [(s, r, _m(_M0)) for s, r in PORTER_STEP2]
    logi = F.when(w.endswith("logi") & _cut(w, 3).rlike(_M0), _cut(w, 1)).otherwise(w)
    return _first_rule(w, rules, logi)


def _porter_2_again(w: Column, before: Column) -> Column:
    """-alli becomes -al and is tried once more."""
    again = before.endswith("alli") & (F.length(w) < F.length(before))
    return F.when(again, _porter_2(w)).otherwise(w)


def _porter_4(w: Column) -> Column:
    def condition(suffix: str) -> Condition:
        if suffix == "ion":
            return lambda s: s.rlike(_M2) & s.rlike("[st]$")
        return _m(_M2)
    return _first_rule(w, [(s, "", condition(s)) for s in PORTER_STEP4])


def _porter_e(w: Column) -> Column:
    s = _cut(w, 1)
    drop = s.rlike(_M2) | (s.rlike(_M1) & ~s.rlike(_CVC))
    return F.when(w.endswith("e") & drop, s).otherwise(w)


def _porter_ll(w: Column) -> Column:
    return F.when(w.endswith("ll") & _cut(w, 1).rlike(_M2), _cut(w, 1)).otherwise(w)


def porter(df: DataFrame, word: str, out: str) -> DataFrame:
    """Add the Porter stem of `word` (lowercased first)."""
    df = df.withColumn(out, F.regexp_replace(F.lower(F.col(word)), "^y", "Y"))
    df = _stages(df, out, [_porter_plural, _porter_past, _porter_repair, _porter_y])
    df = df.withColumn("__before", F.col(out)).withColumn(out, _porter_2(F.col(out)))
    df = df.withColumn(out, _porter_2_again(F.col(out), F.col("__before"))).drop("__before")
    df = _stages(df, out, [
        lambda w: _first_rule(w, [(s, r, _m(_M0)) for s, r in PORTER_STEP3]),
        _porter_4, _porter_e, _porter_ll])
    return df.withColumn(out, _unless_listed(F.col(word), F.lower(F.col(out)), PORTER_IRREGULAR))


def _unless_listed(word: Column, stem: Column, listed: dict[str, str], shortest: int = 3) -> Column:
    low = F.lower(word)
    known = F.create_map(*[F.lit(x) for kv in listed.items() for x in kv])
    return (F.when(low.isin(list(listed)), F.element_at(known, low))
            .when(F.length(low) < shortest, low).otherwise(stem))


# --- Snowball English ----------------------------------------------------------

# Words that do not follow the rules.
SNOWBALL_IRREGULAR = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
    "inning": "inning", "innings": "inning", "outing": "outing", "outings": "outing",
    "canning": "canning", "cannings": "canning", "herring": "herring", "herrings": "herring",
    "earring": "earring", "earrings": "earring",
    "proceed": "proceed", "proceeds": "proceed", "proceeded": "proceed", "proceeding": "proceed",
    "exceed": "exceed", "exceeds": "exceed", "exceeded": "exceed", "exceeding": "exceed",
    "succeed": "succeed", "succeeds": "succeed", "succeeded": "succeed", "succeeding": "succeed",
}

# The regions after the first and second vowel–consonant change,
# short syllables, and the suffix tables of steps 2, 3 and 4 (longest first).
_R1 = "^((gener|commun|arsen)|.*?[aeiouy][^aeiouy])"
_R2 = "^.*?[aeiouy][^aeiouy]"
_SHORT = "([^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$"
SNOWBALL_STEP2 = (
    ("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"),
    ("iveness", "ive"), ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"),
    ("entli", "ent"), ("ation", "ate"), ("alism", "al"), ("aliti", "al"), ("ousli", "ous"),
    ("iviti", "ive"), ("fulli", "ful"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"),
    ("izer", "ize"), ("ator", "ate"), ("alli", "al"), ("bli", "ble"), ("ogi", "og"), ("li", ""),
)
SNOWBALL_STEP3 = (
    ("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"),
    ("ative", ""), ("ical", "ic"), ("ness", ""), ("ful", ""),
)
SNOWBALL_STEP4 = (
    "ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti",
    "ous", "ive", "ize", "ion", "al", "er", "ic",
)


def _from(region: str) -> Condition:
    return lambda stem: F.length(stem) >= F.col(region)


def _snow_plural(w: Column) -> Column:
    early = F.when(F.length(w) > 4, _cut(w, 2)).otherwise(_cut(w, 1))
    return (F.when(w.endswith("sses"), _cut(w, 2))
            .when(w.endswith("ied") | w.endswith("ies"), early)
            .when(w.rlike("(us|ss)$"), w)
            .when(w.rlike("[aeiouy].+s$"), _cut(w, 1)).otherwise(w))


def _snow_past(w: Column) -> Column:
    inside = _from("__r1")
    bare = (F.when(w.endswith("ingly"), _cut(w, 5)).when(w.endswith("edly"), _cut(w, 4))
            .when(w.endswith("ing"), _cut(w, 3)).when(w.endswith("ed"), _cut(w, 2)))
    return (F.when(w.endswith("eedly"), F.when(inside(_cut(w, 5)), _cut(w, 3)).otherwise(w))
            .when(w.endswith("eed"), F.when(inside(_cut(w, 3)), _cut(w, 1)).otherwise(w))
            .when(bare.rlike("[aeiouy]"), F.concat(bare, F.lit("+"))).otherwise(w))


def _snow_repair(w: Column) -> Column:
    s = _cut(w, 1)
    short = s.rlike(_SHORT) & (F.length(s) <= F.col("__r1"))
    return (F.when(~w.endswith("+"), w)
            .when(s.rlike("(at|bl|iz)$"), F.concat(s, F.lit("e")))
            .when(s.rlike(r"(bb|dd|ff|gg|mm|nn|pp|rr|tt)$"), _cut(s, 1))
            .when(short, F.concat(s, F.lit("e"))).otherwise(s))


def _snow_y(w: Column) -> Column:
    return F.when(w.rlike(".[^aeiouy][yY]$"), F.concat(_cut(w, 1), F.lit("i"))).otherwise(w)


def _snow_2(w: Column) -> Column:
    def condition(suffix: str) -> Condition:
        if suffix == "ogi":
            return lambda s: _from("__r1")(s) & s.endswith("l")
        if suffix == "li":
            return lambda s: _from("__r1")(s) & s.rlike("[cdeghkmnrt]$")
        return _from("__r1")
    return _first_rule(w, [(s, r, condition(s)) for s, r in SNOWBALL_STEP2])


def _snow_3(w: Column) -> Column:
    return _first_rule(w, [(s, r, _from("__r2" if s == "ative" else "__r1")) for s, r in SNOWBALL_STEP3])


def _snow_4(w: Column) -> Column:
    def condition(suffix: str) -> Condition:
        if suffix == "ion":
            return lambda s: _from("__r2")(s) & s.rlike("[st]$")
        return _from("__r2")
    return _first_rule(w, [(s, "", condition(s)) for s in SNOWBALL_STEP4])


def _snow_5(w: Column) -> Column:
    s = _cut(w, 1)
    drop_e = _from("__r2")(s) | (_from("__r1")(s) & ~s.rlike(_SHORT))
    return (F.when(w.endswith("e") & drop_e, s)
            .when(w.endswith("l") & _from("__r2")(s) & s.endswith("l"), s).otherwise(w))


def snowball(df: DataFrame, word: str, out: str) -> DataFrame:
    """Add the Snowball English stem of `word` (lowercased first)."""
    start = F.regexp_replace(F.translate(F.lower(F.col(word)), "’‘‛", "'''"), "^'", "")
    df = df.withColumn(out, F.regexp_replace(start, "(^|[aeiouy])y", "$1Y"))
    df = df.withColumn("__r1", F.when(F.col(out).rlike(_R1), F.length(F.regexp_extract(out, _R1, 0)))
                       .otherwise(F.length(out)))
    rest = F.substring(F.col(out), F.col("__r1") + 1, F.length(out))
    df = df.withColumn("__rest", rest)
    df = df.withColumn("__r2", F.when(F.col("__rest").rlike(_R2),
                                      F.col("__r1") + F.length(F.regexp_extract("__rest", _R2, 0)))
                       .otherwise(F.length(out)))
    df = _stages(df, out, [lambda w: F.regexp_replace(w, "('s'|'s|')$", ""), _snow_plural,
                           _snow_past, _snow_repair, _snow_y, _snow_2, _snow_3, _snow_4, _snow_5])
    stem = F.lower(F.col(out))
    return df.withColumn(out, _unless_listed(F.col(word), stem, SNOWBALL_IRREGULAR)).drop(
        "__r1", "__r2", "__rest")
