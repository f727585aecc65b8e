"""DuckDB SQL for the Porter and Snowball English stems, one table per step."""

from __future__ import annotations

from checks.oracle_sql import BASE, docs, lit, with_

WORDS = "words AS MATERIALIZED (SELECT DISTINCT unnest(tokens) AS word FROM docs)"

# Fixed classes of the Porter measures: consonant run, vowel run.
C, V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"


def ends(w, *suffixes):
    return "(" + " OR ".join(f"suffix({w}, {lit(s)})" for s in suffixes) + ")"


def cut(w, n):
    return f"left({w}, length({w}) - {n})"


def has(w, pattern):
    return f"regexp_matches({w}, {lit(pattern)})"


def m_over_0(w): return has(w, f"^({C})?{V}{C}")
def m_is_1(w): return has(w, f"^({C})?{V}{C}({V})?$")
def m_over_1(w): return has(w, f"^({C})?{V}{C}{V}{C}")
def vowel(w): return has(w, f"^({C})?[aeiouy]")
def cvc(w): return has(w, f"(^{C}[aeiouy][^aeiouwxy]$)|(^[aeiou][^aeiou]$)")


def table(w, pairs, condition, other=None):
    """First suffix that fits decides; `condition(stem, suffix)` allows the change."""
    whens = " ".join(
        f"WHEN {ends(w, s)} THEN CASE WHEN {condition(cut(w, len(s)), s)} THEN {cut(w, len(s))} || {lit(r)} ELSE {w} END"
        for s, r in pairs)
    return f"CASE {whens} ELSE {other or w} END"


def pairs(text):
    """`from:to` words to pairs; nothing after the colon deletes."""
    return [tuple(p.split(":")) for p in text.split()]


def chain(name, start, steps, keep="word"):
    """CTEs name0, name1, … each rewriting w."""
    ctes = [f"{name}0 AS MATERIALIZED ({start})"]
    for i, step in enumerate(steps):
        ctes.append(f"{name}{i + 1} AS MATERIALIZED (SELECT {keep}, {step} AS w FROM {name}{i})")
    return ctes, f"{name}{len(steps)}"


def listed(word, stem, text):
    whens = " ".join(f"WHEN {lit(a)} THEN {lit(b)}" for a, b in pairs(text))
    return f"CASE lower({word}) {whens} ELSE CASE WHEN length({word}) < 3 THEN lower({word}) ELSE {stem} END END"


def porter():
    """CTEs ending in `porter(word, norm)`."""
    w = "w"
    bare = f"CASE WHEN {ends(w, 'ed')} THEN {cut(w, 2)} WHEN {ends(w, 'ing')} THEN {cut(w, 3)} END"
    s = cut(w, 1)
    double = f"(right({s}, 1) = left(right({s}, 2), 1) AND length({s}) > 1 AND {has(f'right({s}, 1)', '[^aeiouylsz]')})"
    second = pairs("ational:ate tional:tion enci:ence anci:ance izer:ize bli:ble alli:al entli:ent eli:e "
                   "ousli:ous ization:ize ation:ate ator:ate alism:al iveness:ive fulness:ful ousness:ous "
                   "aliti:al iviti:ive biliti:ble fulli:ful")

    def second_step(x):
        logi = f"CASE WHEN {ends(x, 'logi')} AND {m_over_0(cut(x, 3))} THEN {cut(x, 1)} ELSE {x} END"
        return table(x, second, lambda stem, _: m_over_0(stem), logi)

    once, twice = second_step("w"), second_step("a.w")  # -alli that became -al is tried again
    steps = [
        f"""CASE WHEN {ends(w, 'ies')} AND length(w) = 4 THEN {cut(w, 1)} WHEN {ends(w, 'sses', 'ies')} THEN {cut(w, 2)}
  WHEN {ends(w, 's')} AND NOT {ends(w, 'ss')} THEN {cut(w, 1)} ELSE w END""",
        f"""CASE WHEN {ends(w, 'ied')} THEN CASE WHEN length(w) = 4 THEN {cut(w, 1)} ELSE {cut(w, 2)} END
  WHEN {ends(w, 'eed')} THEN CASE WHEN {m_over_0(cut(w, 3))} THEN {cut(w, 1)} ELSE w END
  WHEN {vowel(bare)} THEN {bare} || '+' ELSE w END""",
        f"""CASE WHEN NOT {ends(w, '+')} THEN w WHEN {ends(s, 'at', 'bl', 'iz')} THEN {s} || 'e'
  WHEN {double} THEN {cut(s, 1)} WHEN {m_is_1(s)} AND {cvc(s)} THEN {s} || 'e' ELSE {s} END""",
        f"CASE WHEN {has(w, '..+[^aeiou]y$|.[^aeiouy]y$')} THEN {cut(w, 1)} || 'i' ELSE w END",
        once,
        table(w, pairs("icate:ic ative: alize:al iciti:ic ical:ic ful: ness:"), lambda x, _: m_over_0(x)),
        table(w, [(x, "") for x in ("al ance ence er ic able ible ant ement ment ent ion ou ism ate iti "
                                    "ous ive ize").split()],
              lambda x, suffix: m_over_1(x) + (f" AND {has(x, '[st]$')}" if suffix == "ion" else "")),
        f"CASE WHEN {ends(w, 'e')} AND ({m_over_1(s)} OR ({m_is_1(s)} AND NOT {cvc(s)})) THEN {s} ELSE w END",
        f"CASE WHEN {ends(w, 'll')} AND {m_over_1(s)} THEN {s} ELSE w END"]
    first, last = chain("pa", "SELECT word, regexp_replace(lower(word), '^y', 'Y') AS w FROM words", steps[:5])
    again = f"""pb0 AS MATERIALIZED (SELECT a.word, CASE WHEN {ends('b.w', 'alli')} AND length(a.w) < length(b.w)
  THEN {twice} ELSE a.w END AS w FROM {last} a JOIN pa4 b ON b.word = a.word)"""
    rest, end = chain("pb", "", steps[5:])
    irregular = ("sky:sky skies:sky dying:die lying:lie tying:tie news:news innings:inning inning:inning "
                 "outings:outing outing:outing cannings:canning canning:canning howe:howe proceed:proceed "
                 "exceed:exceed succeed:succeed")
    return [*first, again, *rest[1:],
            f"porter AS MATERIALIZED (SELECT word, {listed('word', 'lower(w)', irregular)} AS norm FROM {end})"]


def snowball():
    """CTEs ending in `snowball(word, norm)`."""
    w, s = "w", cut("w", 1)
    short = has(s, "([^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$")
    bare = (f"CASE WHEN {ends(w, 'ingly')} THEN {cut(w, 5)} WHEN {ends(w, 'edly')} THEN {cut(w, 4)} "
            f"WHEN {ends(w, 'ing')} THEN {cut(w, 3)} WHEN {ends(w, 'ed')} THEN {cut(w, 2)} END")

    def within(region):
        return lambda x, _=None: f"length({x}) >= {region}"

    def second(x, suffix):
        extra = {"ogi": f" AND {ends(x, 'l')}", "li": f" AND {has(x, '[cdeghkmnrt]$')}"}.get(suffix, "")
        return within("r1")(x) + extra

    steps = [
        "regexp_replace(w, '(''s''|''s|'')$', '')",
        f"""CASE WHEN {ends(w, 'sses')} THEN {cut(w, 2)}
  WHEN {ends(w, 'ied', 'ies')} THEN CASE WHEN length(w) > 4 THEN {cut(w, 2)} ELSE {cut(w, 1)} END
  WHEN {ends(w, 'us', 'ss')} THEN w WHEN {has(w, '[aeiouy].+s$')} THEN {cut(w, 1)} ELSE w END""",
        f"""CASE WHEN {ends(w, 'eedly')} THEN CASE WHEN {within('r1')(cut(w, 5))} THEN {cut(w, 3)} ELSE w END
  WHEN {ends(w, 'eed')} THEN CASE WHEN {within('r1')(cut(w, 3))} THEN {cut(w, 1)} ELSE w END
  WHEN {has(bare, '[aeiouy]')} THEN {bare} || '+' ELSE w END""",
        f"""CASE WHEN NOT {ends(w, '+')} THEN w WHEN {ends(s, 'at', 'bl', 'iz')} THEN {s} || 'e'
  WHEN {ends(s, *'bb dd ff gg mm nn pp rr tt'.split())} THEN {cut(s, 1)}
  WHEN {short} AND length({s}) <= r1 THEN {s} || 'e' ELSE {s} END""",
        f"CASE WHEN {has(w, '.[^aeiouy][yY]$')} THEN {cut(w, 1)} || 'i' ELSE w END",
        table(w, pairs("ization:ize ational:ate fulness:ful ousness:ous iveness:ive tional:tion biliti:ble "
                       "lessli:less entli:ent ation:ate alism:al aliti:al ousli:ous iviti:ive fulli:ful "
                       "enci:ence anci:ance abli:able izer:ize ator:ate alli:al bli:ble ogi:og li:"), second),
        table(w, pairs("ational:ate tional:tion alize:al icate:ic iciti:ic ative: ical:ic ness: ful:"),
              lambda x, suffix: within("r2" if suffix == "ative" else "r1")(x)),
        table(w, [(x, "") for x in ("ement ance ence able ible ment ant ent ism ate iti ous ive ize ion "
                                    "al er ic").split()],
              lambda x, suffix: within("r2")(x) + (f" AND {has(x, '[st]$')}" if suffix == "ion" else "")),
        f"""CASE WHEN {ends(w, 'e')} AND ({within('r2')(s)} OR ({within('r1')(s)} AND NOT {short})) THEN {s}
  WHEN {ends(w, 'l')} AND {within('r2')(s)} AND {ends(s, 'l')} THEN {s} ELSE w END"""]
    region = "^.*?[aeiouy][^aeiouy]"
    start = f"""SELECT word, r1, r1 + CASE WHEN {has('rest', region)} THEN length(regexp_extract(rest, {lit(region)}))
  ELSE length(rest) END AS r2, w FROM (SELECT *, substr(w, r1 + 1) AS rest FROM (
  SELECT *, CASE WHEN {has('w', '^((gener|commun|arsen)|.*?[aeiouy][^aeiouy])')}
    THEN length(regexp_extract(w, '^((gener|commun|arsen)|.*?[aeiouy][^aeiouy])')) ELSE length(w) END AS r1 FROM (
  SELECT word, regexp_replace(regexp_replace(lower(word), '^''', ''), '(^|[aeiouy])y', '\\1Y', 'g') AS w FROM words)))"""
    ctes, end = chain("sn", start, steps, "word, r1, r2")
    irregular = ("skis:ski skies:sky dying:die lying:lie tying:tie idly:idl gently:gentl ugly:ugli early:earli "
                 "only:onli singly:singl sky:sky news:news howe:howe atlas:atlas cosmos:cosmos bias:bias "
                 "andes:andes " + " ".join(f"{x}:{x} {x}s:{x}" for x in "inning outing canning herring earring".split())
                 + " " + " ".join(f"{x}:{x} {x}s:{x} {x}ed:{x} {x}ing:{x}" for x in "proceed exceed succeed".split()))
    return [*ctes, f"snowball AS MATERIALIZED (SELECT word, {listed('word', 'lower(w)', irregular)} AS norm FROM {end})"]


def stems(lemma_query: str) -> dict[str, str]:
    """`lemma_query` gives (word, norm) of the plural rule."""
    both = (*BASE, docs(), WORDS, *porter(), *snowball(), f"lemma AS ({lemma_query})")
    methods = ("porter", "snowball", "lemma")
    q = {f"stem_vocab_{m}": with_(*both) + f"SELECT word, norm FROM {m}" for m in methods[:2]}
    q["vocab_reduction"] = with_(*both) + " UNION ALL ".join(
        f"""SELECT {lit(m)} AS method, count(*) AS original_vocab, count(DISTINCT norm) AS new_vocab,
round((1 - count(DISTINCT norm) / count(*)) * 100, 6) AS reduction_pct FROM {m}""" for m in methods)
    q["over_stemming"] = with_(*both) + " UNION ALL ".join(
        f"""SELECT {lit(m)} AS method, count(*) AS n_terms, count(*) FILTER (WHERE length(norm) < length(word) * 0.5
{"OR norm = left(word, 3)" if m != "lemma" else ""}) AS over_stemmed FROM {m}""" for m in methods)
    return q
