"""DuckDB SQL for the registered queries, written apart from the Spark code.

Patterns avoid look-around and back-references; both are missing in RE2.
"""

from __future__ import annotations

from lexmill.functions.wordlists import (ALPHAS, CLASSES, CODE_SWITCH_WORDS, FAKE_RATINGS,
                                         NEGATION_WORDS, REAL_RATINGS, stopwords)

# Fixed character classes, as in the cleaning patterns.
W = r"[\p{L}\p{N}_]"
SP = (r"\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
EMOJI = (r"[\x{1F600}-\x{1F64F}\x{24C2}-\x{1F251}\x{10000}-\x{10FFFF}\x{2640}-\x{2642}"
         r"\x{2600}-\x{2B55}\x{200D}\x{23CF}\x{23E9}\x{231A}\x{FE0F}\x{3030}]+")
MAX_TERMS = 10_000


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(words) -> str:
    return "(" + ", ".join(lit(w) for w in words) + ")"


def sub(x: str, pattern: str, to: str = " ") -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(to)}, 'g')"


def html(x): return sub(x, r"<[^>]+>")
def urls(x): return sub(x, rf"https?://[^{SP}]+|www\.[^{SP}]+|ftp://[^{SP}]+")
def emails(x): return sub(x, rf"[^{SP}]+@[^{SP}]+\.[^{SP}]+")
def handles(x): return sub(sub(x, rf"@{W}+"), rf"#{W}+")
def emoji(x): return sub(x, EMOJI)


def punct(x):
    for mark in ("!", r"\?", r"\."):
        x = sub(x, mark + "{2,}", mark[-1])
    return sub(x, "-{2,}", "—")


def numbers(x):
    once = r"(^|[^\p{L}\p{N}_])\p{Nd}{4,}($|[^\p{L}\p{N}_])"
    x = sub(sub(x, once, r"\1 NUM \2"), once, r"\1 NUM \2")
    return sub(sub(x, r"\$[\p{Nd},.]+", " MONEY "), r"\p{Nd}+%", " PERCENT ")


def specials(x): return sub(x, rf"""[^\p{{L}}\p{{N}}_{SP}.,!?;:'"-]""")
def space(x): return f"trim({sub(x, f'[{SP}]+')})"


def clean(x, aggressive=False):
    x = punct(emoji(handles(emails(urls(html(f"coalesce({x}, '')"))))))
    if aggressive:
        x = specials(numbers(x))
    return space(f"lower({x})")


def vec_tokens(x): return f"regexp_extract_all(lower({x}), {lit(W + '{2,}')})"


def regex_tokens(x):
    p = rf"""(?:[A-Za-z]\.)+|{W}+(?:[-']{W}+)*|[.,!?;:"'()\[\]{{}}\-]"""
    return f"regexp_extract_all({x}, {lit(p)})"


def white_tokens(x): return f"list_filter(string_split({space(x)}, ' '), lambda t: t <> '')"


def split_tokens(x):
    x = f"' ' || {space(x)} || ' '"
    for p, to in (
            (r"([«“‘„»”’]|`+)", r" \1 "),
            (r'([ (\[{<])"', r"\1 `` "),
            ('"' + "|''", " '' "),
            (r"(\.{2,}|--)", r" \1 "),
            (r"([\]\[(){}<>;@#$%&?!*])", r" \1 "),
            (r"([:,])([^\p{Nd}])", r" \1 \2"),
            (r"([\p{L}\p{N}_]{2}|[^\p{L}\p{N}_. ])\.([\])}>\"'»”’]*) ", r"\1 . \2 ")):
        x = sub(x, p, to)
    x = f"'  ' || replace({space(x)}, ' ', '  ') || '  '"
    for p, to in (
            (r"([^' ])((?i:'s|'m|'d|'ll|'re|'ve|n't)|') ", r"\1 \2 "),
            (r" ((?i:can))((?i:not)) ", r" \1 \2 "),
            (r" ((?i:d))((?i:'ye)) ", r" \1 \2 "),
            (r" ((?i:gim|lem))((?i:me)) ", r" \1 \2 "),
            (r" ((?i:gon|wan))((?i:na)) ", r" \1 \2 "),
            (r" ((?i:got))((?i:ta)) ", r" \1 \2 "),
            (r" ((?i:more))((?i:'n)) ", r" \1 \2 "),
            (r" ((?i:'t))((?i:is|was)) ", r" \1 \2 ")):
        x = sub(x, p, to)
    return f"list_filter(string_split_regex(trim({x}), ' +'), lambda t: t <> '')"


TOKENS = {"regex": regex_tokens, "contractions": split_tokens,
          "whitespace": white_tokens, "vectorizer": vec_tokens}


def unlisted(tokens, words):
    return f"list_filter({tokens}, lambda t: lower(t) NOT IN {in_list(words)})"


def r6(x): return f"round({x}, 6) + 0.0"


# --- shared common table expressions -----------------------------------------

CORPUS = """corpus AS (
  SELECT d.doc_id, d.text, d.source,
         CASE WHEN l.toxic = 1 THEN 'Fake' WHEN l.quality = 1 THEN 'Real' ELSE 'Satire' END AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""
CLEANED = f"""cleaned AS (
  SELECT * FROM (SELECT doc_id, label, text, {clean('text')} AS text_clean FROM corpus)
  WHERE length(text_clean) > 10)"""


def docs(tokenizer="vectorizer", stop="custom"):
    t = TOKENS[tokenizer]("text_clean")
    if stop:
        t = unlisted(t, stopwords(stop))
    return f"docs AS (SELECT doc_id, label, {t} AS tokens FROM cleaned)"


TF = """tf AS (
  SELECT doc_id, label, term, count(*) AS tf
  FROM (SELECT doc_id, label, unnest(tokens) AS term FROM docs) GROUP BY ALL)"""


def vocab(n=MAX_TERMS, source="tf"):
    return f"""vocab AS (
  SELECT *, row_number() OVER (ORDER BY term) - 1 AS idx FROM (
    SELECT term, CAST(sum(tf) AS BIGINT) AS cf, count(*) AS df FROM {source} GROUP BY term
    ORDER BY cf DESC, term LIMIT {n}))"""


def idf(variant="sublinear", n="(SELECT count(*) FROM docs)"):
    n = f"CAST({n} AS DOUBLE)"
    ratio = f"{n} / df" if variant == "standard" else f"(1 + {n}) / (1 + df)"
    return f"fitted AS (SELECT *, ln({ratio}) + 1 AS idf FROM vocab)"


def weights(variant="sublinear", source="tf", name="w"):
    scale = "(1 + ln(tf))" if variant == "sublinear" else "tf"
    return f"""{name} AS (
  SELECT doc_id, label, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS w
  FROM (SELECT t.*, {scale} * f.idf AS raw FROM {source} t JOIN fitted f ON t.term = f.term))"""


def split(source="docs", size="ceil(CAST(0.2 AS DOUBLE) * sum(n) OVER ())"):
    return f"""sizes AS (SELECT label, count(*) AS n FROM {source} GROUP BY label),
shares AS (SELECT label, n, n * least({size}, sum(n) OVER ()) / sum(n) OVER () AS exact,
                  least({size}, sum(n) OVER ()) AS wanted FROM sizes),
targets AS (
  SELECT label, floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, label)
         <= wanted - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS target FROM shares),
split AS (
  SELECT s.*, s.rn <= t.target AS is_test FROM (
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || doc_id)) AS rn
    FROM {source}) s JOIN targets t ON s.label = t.label)"""


def with_(*ctes):
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = (CORPUS, CLEANED)
WORDS = (*BASE, docs(), TF)

# Naive Bayes on counts: class sums, log likelihoods, scores of test documents.
NB = (*BASE, docs(), TF, vocab(), split(),
      """train AS (SELECT doc_id, label FROM split WHERE NOT is_test)""",
      """sums AS (SELECT v.term, c.label, coalesce(s.s, 0) AS s
  FROM vocab v CROSS JOIN (SELECT DISTINCT label FROM docs) c
  LEFT JOIN (SELECT tf.term, tf.label, sum(tf.tf) AS s FROM tf JOIN train USING (doc_id)
             GROUP BY tf.term, tf.label) s ON s.term = v.term AND s.label = c.label)""",
      """priors AS (SELECT label, ln(count(*) / (SELECT count(*) FROM train)) AS lp FROM train GROUP BY label)""",
      """ll AS (SELECT term, label, ln((s + CAST(1.0 AS DOUBLE)) / (sum(s) OVER (PARTITION BY label)
    + CAST(1.0 AS DOUBLE) * count(*) OVER (PARTITION BY label))) AS ll FROM sums)""",
      """lp AS (SELECT d.doc_id, d.label, p.label AS class,
    p.lp + coalesce(list_sum(list_sort(list(tf.tf * ll.ll))), 0) AS lp
  FROM split d CROSS JOIN priors p LEFT JOIN tf ON tf.doc_id = d.doc_id
  LEFT JOIN ll ON ll.term = tf.term AND ll.label = p.label
  WHERE d.is_test GROUP BY d.doc_id, d.label, p.label, p.lp)""",
      """scored AS (SELECT doc_id, label, class, lp, e / list_sum(list_sort(list(e) OVER (PARTITION BY doc_id))) AS p
  FROM (SELECT *, exp(lp - max(lp) OVER (PARTITION BY doc_id)) AS e FROM lp))""",
      """pred AS (SELECT doc_id, label, class AS prediction FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY lp DESC, class) AS rn FROM lp) WHERE rn = 1)""")


def prf(source="pred", by=""):
    """Per-class table `prf` from (by…, label, prediction) rows."""
    b = by + ", " if by else ""
    return f"""sides AS (
  SELECT {b}label AS class, count(*) AS support, 0 AS predicted,
         count(*) FILTER (WHERE label = prediction) AS tp FROM {source} GROUP BY {b}label
  UNION ALL SELECT {b}prediction, 0, count(*), 0 FROM {source} GROUP BY {b}prediction),
prf0 AS (SELECT {b}class, CAST(sum(support) AS BIGINT) AS support, CAST(sum(tp) AS BIGINT) AS tp,
    CASE WHEN sum(predicted) > 0 THEN sum(tp) / sum(predicted) ELSE 0.0 END AS "precision",
    CASE WHEN sum(support) > 0 THEN sum(tp) / sum(support) ELSE 0.0 END AS recall
  FROM sides GROUP BY {b}class),
prf AS (SELECT *, CASE WHEN "precision" + recall > 0
    THEN 2 * "precision" * recall / ("precision" + recall) ELSE 0.0 END AS f1 FROM prf0)"""


def weighted(by=""):
    b = by + ", " if by else ""
    cols = ", ".join(f"round(sum({c} * support) / sum(support), 6) AS {c}"
                     for c in ('"precision"', "recall", "f1"))
    group = f" GROUP BY {by}" if by else ""
    return f"SELECT {b}round(sum(tp) / sum(support), 6) AS accuracy, {cols} FROM prf{group}"


SCORE_GROUPS = """groups AS (SELECT class, p AS score,
    count(*) FILTER (WHERE label = class) AS pos, count(*) FILTER (WHERE label <> class) AS neg
  FROM scored GROUP BY class, p)"""


# --- n-gram models -------------------------------------------------------------

def grams(n, source="docs", pads=None, name="grams"):
    pads = n - 1 if pads is None else pads
    pad = "[" + ", ".join(["'<s>'"] * pads) + "]::VARCHAR[]"
    context = " || ' ' || ".join(f"p[i + {j}]" for j in range(n - 1)) or "''"
    return f"""{name} AS (
  SELECT doc_id, label, {context} AS context, p[i + {n - 1}] AS word FROM (
    SELECT doc_id, label, p, unnest(range(1, len(p) - {n - 2})) AS i FROM (
      SELECT doc_id, label, {pad} || tokens || ['</s>'] AS p FROM {source})))"""


LM_SPLIT = (*BASE, docs(), "lmdocs AS (SELECT * FROM docs WHERE label IN ('Real', 'Fake'))",
            split("lmdocs", "100"),
            "trn AS (SELECT doc_id, label, tokens FROM split WHERE NOT is_test)",
            "tst AS (SELECT doc_id, label, tokens FROM split WHERE is_test)")


def lm(n, smoothing, mode="as_implemented", tag=""):
    """CTEs ending in `scored{tag}`: test n-grams × class with probability p."""
    cnt, ctx = f"cnt{tag}", f"ctx{tag}"
    ctes = [
        grams(n, "trn", name=f"tg{tag}"), grams(n, "tst", name=f"sg{tag}"),
        f"{cnt} AS (SELECT label, context, word, count(*) AS c FROM tg{tag} GROUP BY ALL)",
        f"{ctx} AS (SELECT label, context, sum(c) AS ctx, count(*) AS fol FROM {cnt} GROUP BY ALL)",
        f"""sz{tag} AS (SELECT label, count(*) AS T, count(DISTINCT w) + 2 AS V
  FROM (SELECT label, unnest(tokens) AS w FROM trn) GROUP BY label)"""]
    cont = f"(SELECT NULL AS label, NULL AS word, 0 AS cont LIMIT 0)"
    types = f"(SELECT label, 0 AS types FROM sz{tag})"
    if smoothing == "kneser_ney":
        ctes += [grams(2, "trn", n - 1, f"bg{tag}"),
                 f"bt{tag} AS (SELECT DISTINCT label, context, word FROM bg{tag})",
                 f"ct{tag} AS (SELECT label, word, count(*) AS cont FROM bt{tag} GROUP BY ALL)",
                 f"ty{tag} AS (SELECT label, count(*) AS types FROM bt{tag} GROUP BY label)"]
        cont, types = f"ct{tag}", f"ty{tag}"
    floor = "CAST(1e-10 AS DOUBLE)"
    if n == 1:
        p = ("(coalesce(c.c, 0) + 1) / (z.T + z.V)" if smoothing == "laplace"
             else f"CASE WHEN c.c > 0 THEN c.c / z.T ELSE {floor} END")
    elif smoothing == "laplace":
        p = "(coalesce(c.c, 0) + 1) / (coalesce(x.ctx, 0) + z.V)"
    elif smoothing == "none":
        p = f"CASE WHEN c.c > 0 THEN c.c / x.ctx ELSE {floor} END"
    else:
        fol = "1" if n > 2 and mode == "as_implemented" else "x.fol"
        pc = f"greatest(coalesce(k.cont, 0), {floor}) / y.types"
        p = f"""greatest({floor}, CASE WHEN x.ctx > 0 THEN
    (greatest(coalesce(c.c, 0) - CAST(0.75 AS DOUBLE), 0) + CAST(0.75 AS DOUBLE) * {fol} * {pc}) / x.ctx
    ELSE {pc} END)"""
    ctes.append(f"""scored{tag} AS (
  SELECT g.doc_id, g.label, g.context, g.word, g.m, z.label AS class, {p} AS p
  FROM (SELECT doc_id, label, context, word, count(*) AS m FROM sg{tag} GROUP BY ALL) g
  CROSS JOIN sz{tag} z
  LEFT JOIN {cnt} c ON c.label = z.label AND c.context = g.context AND c.word = g.word
  LEFT JOIN {ctx} x ON x.label = z.label AND x.context = g.context
  LEFT JOIN {cont} k ON k.label = z.label AND k.word = g.word
  LEFT JOIN {types} y ON y.label = z.label)""")
    return ctes


def pp(tag=""):
    return f"""pp{tag} AS (SELECT doc_id, label, class, exp(-sum(m * ln(p)) / sum(m)) AS pp
  FROM scored{tag} GROUP BY doc_id, label, class),
pred{tag} AS (SELECT doc_id, label, class AS prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pp, class = 'Fake') AS rn FROM pp{tag})
  WHERE rn = 1)"""


def lm_query(n, smoothing, mode="as_implemented"):
    return with_(*LM_SPLIT, *lm(n, smoothing, mode)) + """
SELECT context, word, CAST(sum(m) FILTER (WHERE class = 'Real') AS BIGINT) AS m,
  round(max(ln(p)) FILTER (WHERE class = 'Real'), 6) AS "log_p_Real",
  round(max(ln(p)) FILTER (WHERE class = 'Fake'), 6) AS "log_p_Fake"
FROM scored GROUP BY context, word"""


def step(expr, table="documents", key="doc_id"):
    return f"SELECT {key}, {expr} AS result FROM {table}"


RATED = """rated AS (SELECT doc_id, text, ['true', 'mostly-true', 'half-true', 'false', 'pants-fire',
   'barely-true', 'unrated'][CAST(regexp_extract(source, '[0-9]+') AS INT) % 8 + 1] AS rating
  FROM documents),
mapped AS (SELECT *, CASE WHEN rating IN {real} THEN 'Real' WHEN rating IN {fake} THEN 'Fake' END
  AS mapped_label FROM rated)""".format(real=in_list(REAL_RATINGS), fake=in_list(FAKE_RATINGS))

LEXICON = f"known AS (SELECT DISTINCT unnest({vec_tokens('text')}) AS w FROM benchmark)"
ALLCLEAN = f"rows AS (SELECT doc_id, {clean('text')} AS text_clean FROM documents)"


def oov(source):
    """Per (key columns of) source rows with `tokens`, the share not in `known`."""
    return f"""ascii AS (SELECT doc_id, tokenizer, lower(t) AS w FROM (
    SELECT doc_id, tokenizer, unnest(tokens) AS t FROM {source}) WHERE regexp_matches(t, '^[a-zA-Z]+$')),
oov AS (SELECT s.doc_id, s.tokenizer, len(s.tokens) AS n, coalesce(o.rate, 0.0) AS rate
  FROM {source} s LEFT JOIN (
    SELECT doc_id, tokenizer, avg(CASE WHEN k.w IS NULL THEN 1.0 ELSE 0.0 END) AS rate
    FROM ascii a LEFT JOIN known k ON a.w = k.w GROUP BY doc_id, tokenizer) o
  ON o.doc_id = s.doc_id AND o.tokenizer = s.tokenizer)"""


AUDIT_SAMPLE = "s AS (SELECT doc_id, text FROM documents ORDER BY md5('42:' || doc_id) LIMIT 200)"


def count_matches(pattern): return f"len(regexp_extract_all(text, {lit(pattern)}))"


def oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    q["map_labels"] = with_(RATED) + "SELECT doc_id, rating, mapped_label FROM mapped"
    q["drop_missing"] = with_(RATED) + """SELECT doc_id, mapped_label FROM mapped
WHERE mapped_label IS NOT NULL AND text IS NOT NULL"""
    q["keep_flagged"] = "SELECT doc_id, 'Satire' AS label FROM labels WHERE toxic = 1"
    q["conform"] = with_(RATED) + """SELECT md5(text) AS text_md5, mapped_label AS label,
'statements' AS source, rating AS original_label FROM mapped"""
    q["drop_short_clean"] = with_(ALLCLEAN) + """SELECT doc_id, length(text_clean) AS n_clean
FROM rows WHERE length(text_clean) > 10"""
    q["keep_classes"] = with_(CORPUS) + "SELECT doc_id, label FROM corpus WHERE label IN ('Real', 'Fake')"
    q["encode_labels"] = with_(CORPUS) + """SELECT doc_id, label,
dense_rank() OVER (ORDER BY label) - 1 AS label_idx FROM corpus"""
    q["decode_labels"] = with_(CORPUS) + """SELECT doc_id, label,
dense_rank() OVER (ORDER BY label) - 1 AS label_idx FROM corpus"""
    reason = """CASE WHEN text IS NULL OR length(text) < 10 THEN 'too_short'
      WHEN length(text) > 10000 THEN 'too_long' END"""
    q["validate_texts"] = f"SELECT doc_id, {reason} AS reason, {reason} IS NULL AS accepted FROM documents"
    q["validate_batches"] = f"""WITH m AS (SELECT conv_id, turn, {reason} AS why FROM conversations),
b AS (SELECT conv_id, count(*) AS size, min(turn) FILTER (WHERE why IS NOT NULL) AS first_bad,
  arg_min(why, turn) FILTER (WHERE why IS NOT NULL) AS why FROM m GROUP BY conv_id)
SELECT conv_id, size, first_bad, CASE WHEN size > 100 THEN 'batch_too_large' ELSE why END AS error,
  CASE WHEN size > 100 THEN 'batch_too_large' ELSE why END IS NULL AS accepted FROM b"""
    q["preview"] = "SELECT doc_id, " + ", ".join(
        f"substring(text, 1, {n}) AS first_{n}" for n in (60, 80, 100, 500)) + " FROM documents"

    q["union_sources"] = """SELECT source, md5(text) AS text_md5 FROM (
SELECT text, source FROM documents UNION ALL SELECT text, 'benchmark' FROM benchmark
UNION ALL SELECT text, role FROM conversations)"""
    q["sample_n"] = "SELECT doc_id, source FROM documents ORDER BY md5('42:' || doc_id) LIMIT 200"
    q["cap_per_group"] = """SELECT doc_id, source, lang FROM (SELECT *, row_number() OVER (
PARTITION BY source, lang ORDER BY md5('42:' || doc_id)) AS rn FROM documents) WHERE rn <= 20"""
    q["cap_per_class"] = with_(CORPUS) + """SELECT doc_id, label FROM (SELECT *, row_number() OVER (
PARTITION BY label ORDER BY md5('42:' || doc_id)) AS rn FROM corpus)
WHERE rn <= CASE label WHEN 'Real' THEN 150 WHEN 'Fake' THEN 30 ELSE rn END"""
    q["dedup_exact"] = """SELECT doc_id, source FROM (SELECT *, row_number() OVER (
PARTITION BY text ORDER BY source, doc_id) AS rn FROM documents) WHERE rn = 1"""
    q["duplicate_rate"] = """SELECT count(text) AS n, count(DISTINCT text) AS n_distinct,
round((count(text) - count(DISTINCT text)) / count(text), 6) AS rate FROM documents"""
    dist = "count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct"
    q["class_distribution"] = with_(CORPUS) + f"SELECT label, {dist} FROM corpus GROUP BY label"
    q["source_distribution"] = f"SELECT source, {dist} FROM documents GROUP BY source"
    q["balance_undersample"] = with_(CORPUS) + """, c AS (SELECT label, count(*) AS n FROM corpus GROUP BY label)
SELECT doc_id, label, 1.0::DOUBLE AS sample_weight FROM (SELECT doc_id, label, row_number() OVER (
PARTITION BY label ORDER BY md5('42:' || doc_id)) AS rn FROM corpus)
WHERE rn <= (SELECT CASE WHEN max(n) / sum(n) > 0.40 THEN min(n) ELSE max(n) END FROM c)"""
    q["balance_class_weighted"] = with_(CORPUS) + """, c AS (SELECT label, count(*) AS n FROM corpus GROUP BY label),
t AS (SELECT sum(n) AS total, count(*) AS k, max(n) / sum(n) > 0.40 AS act FROM c)
SELECT doc_id, corpus.label, round(CASE WHEN act THEN total / (k * n) ELSE 1.0 END, 6) AS sample_weight
FROM corpus JOIN c ON c.label = corpus.label CROSS JOIN t"""
    ids = "ids AS (SELECT doc_id, label FROM corpus)"
    q["stratified_split"] = with_(CORPUS, ids, split("ids")) + "SELECT doc_id, label, is_test FROM split"
    q["stratified_split_count"] = with_(CORPUS, ids, split("ids", "100")) + \
        "SELECT doc_id, label, is_test FROM split"

    q["strip_html"] = step(html("html"), "pages", "page_id")
    q["strip_urls"] = step(urls("html"), "pages", "page_id")
    q["strip_emails"] = step(emails("text"))
    q["strip_handles"] = step(handles("text"))
    q["strip_emoji"] = step(emoji("text"))
    q["squeeze_punct"] = step(punct("text"))
    q["mask_numbers"] = step(numbers("text"))
    q["strip_specials"] = step(specials("text"))
    q["fold_case"] = step("lower(text)")
    q["squeeze_space"] = step(space("text"))
    q["clean_text"] = step(clean("text"))
    q["clean_text_aggressive"] = step(clean("text", True))
    q["clean_pages"] = step(clean("html"), "pages", "page_id")
    markers = f"len(list_filter({vec_tokens('text')}, lambda t: t IN {in_list(CODE_SWITCH_WORDS)}))"
    n_words = f"len({vec_tokens('text')})"
    q["code_switch_ratio"] = f"""SELECT doc_id,
round(CASE WHEN {n_words} > 0 THEN {markers} / {n_words} ELSE 0.0 END, 6) AS share FROM documents"""
    q["clean_corpus"] = with_(*BASE) + "SELECT doc_id, label, text_clean FROM cleaned"
    q["noise_audit"] = with_(AUDIT_SAMPLE, f"c AS (SELECT *, {clean('text')} AS cl FROM s)") + f"""
SELECT count(*) AS total_samples,
  CAST(sum({count_matches('<[^>]+>')}) AS BIGINT) AS html_tags_found,
  CAST(sum({count_matches(rf'https?://[^{SP}]+|www[.][^{SP}]+')}) AS BIGINT) AS urls_found,
  CAST(sum({count_matches(f'[@#]{W}+')}) AS BIGINT) AS social_handles_found,
  CAST(sum({count_matches('!{2,}|[?]{2,}|[.]{2,}')}) AS BIGINT) AS repeated_punct_found,
  CAST(sum({count_matches(EMOJI)}) AS BIGINT) AS emojis_found,
  CAST(sum({count_matches(rf'[^{SP}]+@[^{SP}]+[.][^{SP}]+')}) AS BIGINT) AS email_addresses_found,
  round(avg(length(text)), 6) AS avg_length_before, round(avg(length(cl)), 6) AS avg_length_after,
  round(avg(len({white_tokens('text')})), 6) AS avg_tokens_before,
  round(avg(len({white_tokens('cl')})), 6) AS avg_tokens_after,
  CAST(sum(length(text) - length(cl)) AS BIGINT) AS total_chars_removed,
  round((1 - avg(length(cl)) / avg(length(text))) * 100, 6) AS reduction_pct FROM c"""

    for name, f in TOKENS.items():
        q[f"tokenize_{name}"] = with_(ALLCLEAN) + f"""SELECT doc_id, array_to_string(t, ' ') AS tokens,
len(t) AS n_tokens FROM (SELECT doc_id, {f('text_clean')} AS t FROM rows)"""
    q["oov_rate"] = with_(LEXICON, ALLCLEAN,
        f"src AS (SELECT doc_id, 'regex' AS tokenizer, {regex_tokens('text_clean')} AS tokens FROM rows)",
        oov("src")) + "SELECT doc_id, round(rate, 6) AS oov_rate FROM oov"
    q["token_stats"] = with_(LEXICON, ALLCLEAN, "src AS (" + " UNION ALL ".join(
        f"SELECT doc_id, {lit(t)} AS tokenizer, {TOKENS[t]('text_clean')} AS tokens FROM rows"
        for t in ("contractions", "regex", "whitespace")) + ")", oov("src")) + """
SELECT tokenizer, round(avg(n), 6) AS avg_tokens, round(stddev_pop(n), 6) AS std_tokens,
  round(avg(rate), 6) AS avg_oov FROM oov GROUP BY tokenizer"""
    q["contraction_accuracy"] = with_(ALLCLEAN, f"""cases AS (SELECT DISTINCT unnest(regexp_extract_all(
text_clean, {lit(W + "+'" + W + "+")})) AS word FROM rows)""") + f"""SELECT count(*) AS n_cases,
round(avg(CASE WHEN len({split_tokens('word')}) >= 2 THEN 1.0 ELSE 0.0 END), 6) AS contractions_accuracy,
round(avg(CASE WHEN len({regex_tokens('word')}) >= 2 THEN 1.0 ELSE 0.0 END), 6) AS regex_accuracy FROM cases"""
    q["preservation_rate"] = with_(ALLCLEAN, f"""tk AS (SELECT doc_id, list_distinct({white_tokens('text_clean')}) AS e,
list_transform({split_tokens('text_clean')}, lambda t: lower(t)) AS f FROM rows)""") + """
SELECT doc_id, round(CASE WHEN len(e) > 0 THEN len(list_intersect(e, f)) / len(e) ELSE 0.0 END, 6) AS preserved FROM tk"""
    q["tokenize_corpus"] = with_(*BASE) + f"""SELECT doc_id, label,
array_to_string({split_tokens('text_clean')}, ' ') AS tokens FROM cleaned"""
    words = " UNION ALL ".join(f"SELECT {lit(k)} AS list, unnest([{', '.join(lit(w) for w in stopwords(k))}]) AS term"
                               for k in ("standard", "custom"))
    q["stopword_list"] = f"""WITH l AS ({words}), n AS (SELECT term, count(*) AS n FROM (
SELECT unnest({vec_tokens('text')}) AS term FROM documents) GROUP BY term)
SELECT list, l.term, coalesce(n, 0) AS n FROM l LEFT JOIN n ON n.term = l.term"""
    plain = (*BASE, docs("regex", None))
    q["remove_stopwords"] = with_(*BASE, docs("regex")) + \
        "SELECT doc_id, array_to_string(tokens, ' ') AS tokens FROM docs"
    rate = "CASE WHEN len(tokens) > 0 THEN 1 - len({}) / len(tokens) ELSE 0.0 END"
    q["removal_rate"] = with_(*plain, "r AS (" + " UNION ALL ".join(
        f"SELECT {lit(k)} AS list, {len(stopwords(k))} AS n, "
        f"{rate.format(unlisted('tokens', stopwords(k)))} AS r FROM docs" for k in ("standard", "custom")) + ")") + """
SELECT list, CAST(any_value(n) AS BIGINT) AS list_size, round(avg(r), 6) AS avg_removal_rate,
round(stddev_pop(r), 6) AS std_removal_rate FROM r GROUP BY list"""
    q["removed_words"] = with_(*plain, f"""g AS (SELECT doc_id, string_agg(w, ' ' ORDER BY w) AS removed FROM (
SELECT DISTINCT doc_id, lower(unnest(tokens)) AS w FROM docs)
WHERE w IN {in_list(stopwords('custom'))} GROUP BY doc_id)""") + """
SELECT docs.doc_id, coalesce(removed, '') AS removed FROM docs LEFT JOIN g ON g.doc_id = docs.doc_id"""
    q["negation_incidence"] = with_(*plain) + " UNION ALL ".join(f"""SELECT {lit(w)} AS word, label,
round(avg(CASE WHEN list_contains(list_transform(tokens, lambda t: lower(t)), {lit(w)}) THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct
FROM docs GROUP BY label""" for w in NEGATION_WORDS)
    q["min_token_length"] = with_(*BASE, docs("regex")) + """SELECT doc_id,
array_to_string(list_filter(tokens, lambda t: length(t) >= 3), ' ') AS tokens FROM docs"""

    q["top_terms_per_class"] = with_(*WORDS) + """SELECT label, rank, term, freq FROM (
SELECT label, term, freq, row_number() OVER (PARTITION BY label ORDER BY freq DESC, term) AS rank
FROM (SELECT label, term, CAST(sum(tf) AS BIGINT) AS freq FROM tf GROUP BY label, term)) WHERE rank <= 30"""
    q["term_counts"] = with_(*WORDS) + "SELECT doc_id, term, tf FROM tf"
    q["vocabulary"] = with_(*WORDS, vocab(10000)) + "SELECT term, idx, cf, df FROM vocab"
    q["matrix_stats"] = with_(*WORDS, vocab(10000)) + """SELECT n_docs, n_features, nnz,
round((1 - nnz / (n_docs * n_features)) * 100, 6) AS sparsity_pct,
round(nnz / (n_docs * n_features) * 100, 6) AS density_pct FROM (
SELECT (SELECT count(*) FROM docs) AS n_docs, count(*) AS n_features, CAST(sum(df) AS BIGINT) AS nnz FROM vocab)"""
    q["export_vocabulary"] = with_(*WORDS, vocab(10000)) + "SELECT term, idx FROM vocab ORDER BY idx LIMIT 100"
    for v in ("standard", "smooth", "sublinear"):
        q[f"tfidf_{v}"] = with_(*WORDS, vocab(), idf(v), weights(v)) + \
            "SELECT doc_id, term, round(w, 6) AS w FROM w"
    q["discriminative_terms"] = with_(*WORDS, vocab(), idf(), weights(), """
c AS (SELECT label, count(*) AS n FROM docs GROUP BY label),
tot AS (SELECT term, sum(w) AS total FROM w GROUP BY term),
ins AS (SELECT label, term, sum(w) AS s FROM w GROUP BY label, term),
sc AS (SELECT c.label, t.term, coalesce(i.s, 0) / c.n
   - (t.total - coalesce(i.s, 0)) / ((SELECT sum(n) FROM c) - c.n) AS score
  FROM tot t CROSS JOIN c LEFT JOIN ins i ON i.term = t.term AND i.label = c.label)""") + """
SELECT label, rank, term, round(score, 6) + 0.0 AS score FROM (SELECT *, row_number() OVER (
PARTITION BY label ORDER BY round(score, 12) DESC, term) AS rank FROM sc) WHERE rank <= 15"""
    bench_tf = f"""qtf AS (SELECT doc_id, NULL AS label, term, count(*) AS tf FROM (
SELECT item_id AS doc_id, unnest({unlisted(vec_tokens(clean('text')), stopwords('custom'))}) AS term
FROM benchmark) GROUP BY ALL)"""
    q["transform_tfidf"] = with_(*WORDS, vocab(), idf(), bench_tf, weights(source="qtf", name="qw")) + \
        "SELECT doc_id, term, round(w, 6) AS w FROM qw"
    q["tfidf_train_scope"] = with_(*WORDS, split(),
        "ttf AS (SELECT tf.* FROM tf JOIN split USING (doc_id) WHERE NOT is_test)",
        vocab(source="ttf"), idf(n="(SELECT count(*) FROM split WHERE NOT is_test)")) + \
        "SELECT term, idx, df, round(idf, 6) AS idf FROM fitted"

    top = """SELECT query_id, rank, doc_id, label, round(similarity, {d}) AS similarity FROM (SELECT *, row_number() OVER (
PARTITION BY query_id ORDER BY round(similarity, 12) DESC, doc_id) AS rank FROM (
SELECT {q} AS query_id, b.doc_id, b.label, sum(a.w * b.w) AS similarity
FROM {a} a JOIN w b ON a.term = b.term {where} GROUP BY ALL) WHERE similarity > 0) WHERE rank <= {k}"""
    picks = "picks AS (SELECT doc_id FROM corpus WHERE doc_id % 20 = 0)"
    near = with_(*WORDS, vocab(), idf(), weights(), picks,
                 "pw AS (SELECT w.* FROM w JOIN picks USING (doc_id))",
                 "hits AS (" + top.format(q="a.doc_id", d=6, a="pw", k=3, where="AND a.doc_id <> b.doc_id") + ")")
    q["similar_docs"] = near + "SELECT * FROM hits"
    q["neighbor_label_agreement"] = near + """SELECT c.label AS query_label, count(*) AS n_matches,
round(avg(CASE WHEN h.label = c.label THEN 1.0 ELSE 0.0 END), 6) AS agreement
FROM hits h JOIN corpus c ON c.doc_id = h.query_id GROUP BY c.label"""
    q["retrieve_similar"] = with_(*WORDS, vocab(), idf(), weights(), bench_tf,
                                  weights(source="qtf", name="qw")) + \
        "SELECT t.*, left(c.text_clean, 500) AS text FROM (" + top.format(
            q="a.doc_id", d=4, a="qw", k=5, where="") + ") t JOIN cleaned c ON c.doc_id = t.doc_id"

    q["context_pairs"] = with_(*BASE, docs(),
        """words AS (SELECT doc_id, term, row_number() OVER () AS o FROM (SELECT doc_id, unnest(tokens) AS term FROM docs)),
pos AS (SELECT doc_id, unnest(tokens) AS center, unnest(range(1, len(tokens) + 1)) AS p FROM docs),
kept AS (SELECT doc_id, center, p FROM pos WHERE center IN (SELECT center FROM pos GROUP BY center HAVING count(*) >= 3))""") + """
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS pos, center,
coalesce(string_agg(center, ' ') OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING
EXCLUDE CURRENT ROW), '') AS context FROM kept"""
    cos = """list_sum(list_transform(range(1, 65), lambda i: {a}[i]::DOUBLE * {b}[i]::DOUBLE))
/ (sqrt(list_sum(list_transform({a}, lambda x: x::DOUBLE * x::DOUBLE)))
   * sqrt(list_sum(list_transform({b}, lambda x: x::DOUBLE * x::DOUBLE))))"""
    q["word_similarity"] = f"""SELECT a.vec_id AS a, a.vec_id + 1 AS b,
CASE WHEN b.vec_id IS NULL THEN NULL ELSE round({cos.format(a='a.embedding', b='b.embedding')}, 6) + 0.0 END AS similarity
FROM embeddings a LEFT JOIN embeddings b ON b.vec_id = a.vec_id + 1"""
    q["nearest_words"] = f"""WITH t AS (SELECT vec_id, embedding FROM embeddings WHERE vec_id % 20 = 0)
SELECT term, rank, neighbor, round(similarity, 6) + 0.0 AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY term
ORDER BY round(similarity, 12) DESC, neighbor) AS rank FROM (SELECT t.vec_id AS term, e.vec_id AS neighbor,
{cos.format(a='t.embedding', b='e.embedding')} AS similarity
FROM t JOIN embeddings e ON e.vec_id <> t.vec_id)) WHERE rank <= 5"""
    q["top_words"] = with_(*WORDS, vocab(10000)) + """SELECT word, cf, array_to_string(list_transform(embedding, lambda x: printf('%.6f', x)), ' ') AS vector FROM (
SELECT e.vec_id AS word, v.cf, e.embedding, v.idx
FROM vocab v JOIN embeddings e ON e.vec_id = v.idx) ORDER BY cf DESC, word LIMIT 200"""

    q["ngrams"] = with_(*BASE, docs(), grams(3)) + \
        "SELECT doc_id, context, word, count(*) AS n FROM grams GROUP BY ALL"
    counts = "cnt AS (SELECT label, context, word, count(*) AS c FROM grams GROUP BY ALL)"
    two = (*BASE, docs(), grams(2), counts)
    q["ngram_counts"] = with_(*two) + "SELECT * FROM cnt"
    q["ngram_context_counts"] = with_(*two) + """SELECT label, context, CAST(sum(c) AS BIGINT) AS ctx,
count(*) AS followers FROM cnt GROUP BY ALL"""
    q["ngram_class_stats"] = with_(*BASE, docs()) + """SELECT label, count(*) AS total_tokens,
count(DISTINCT w) + 2 AS vocab_size FROM (SELECT label, unnest(tokens) AS w FROM docs) GROUP BY label"""
    q["unique_ngram_count"] = with_(*BASE, docs(), grams(1, name="g1"), grams(2, name="g2"), grams(3, name="g3")) + \
        " UNION ALL ".join(f"""SELECT label, count(*) AS unique_ngrams, {n}::BIGINT AS n FROM (
SELECT DISTINCT label, context, word FROM g{n}) GROUP BY label""" for n in (1, 2, 3))
    q["top_ngrams"] = with_(*two) + """SELECT label, rank, ngram, c, round(c / total, 6) AS p FROM (
SELECT label, context || ' ' || word AS ngram, c, sum(c) OVER (PARTITION BY label) AS total,
row_number() OVER (PARTITION BY label ORDER BY c DESC, context || ' ' || word) AS rank FROM cnt) WHERE rank <= 20"""
    q["continuation_stats"] = with_(*two) + """
SELECT label, 'left' AS side, word AS token, count(*) AS n FROM cnt GROUP BY ALL
UNION ALL SELECT label, 'right', context, count(*) FROM cnt GROUP BY ALL
UNION ALL SELECT label, 'types', '', count(*) FROM cnt GROUP BY ALL"""
    q["lm_prob_none"] = lm_query(2, "none")
    q["lm_prob_laplace"] = lm_query(2, "laplace")
    q["lm_prob_laplace_unigram"] = lm_query(1, "laplace")
    q["lm_prob_kneser_ney"] = lm_query(2, "kneser_ney")
    q["lm_prob_kneser_ney_trigram"] = lm_query(3, "kneser_ney")
    q["lm_prob_kneser_ney_formula"] = lm_query(3, "kneser_ney", "formula")
    q["perplexity"] = with_(*LM_SPLIT, *lm(2, "laplace"), pp()) + """SELECT doc_id, label,
round(max(pp) FILTER (WHERE class = 'Real'), 6) AS "pp_Real", round(max(pp) FILTER (WHERE class = 'Fake'), 6) AS "pp_Fake"
FROM pp GROUP BY doc_id, label"""
    q["classify_by_perplexity"] = with_(*LM_SPLIT, *lm(3, "kneser_ney"), pp()) + "SELECT * FROM pred"
    runs = [x for n, s in ((1, "laplace"), (2, "laplace"), (3, "kneser_ney"))
            for x in (*lm(n, s, tag=str(n)), pp(str(n)))]
    q["lm_evaluation"] = with_(*LM_SPLIT, *runs, "pred AS (" + " UNION ALL ".join(
        f'SELECT {n}::BIGINT AS "order", label, prediction FROM pred{n}' for n in (1, 2, 3)) + ")",
        prf(by='"order"')) + weighted('"order"')

    q["nb_fit"] = with_(*NB) + "SELECT term, label AS class, round(ll, 6) AS ll FROM ll"
    q["nb_priors"] = with_(CORPUS, ids, split("ids")) + """SELECT label, round(ln(count(*) / (
SELECT count(*) FROM split WHERE NOT is_test)), 6) AS lp FROM split WHERE NOT is_test GROUP BY label"""
    q["nb_log_proba"] = with_(*NB) + "SELECT doc_id, class, round(lp, 6) AS lp FROM lp"
    q["nb_proba"] = with_(*NB) + "SELECT doc_id, class, round(p, 6) AS p FROM scored"
    q["nb_predict"] = with_(*NB) + "SELECT doc_id, label, prediction FROM pred"
    acc = "SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM pred"
    q["nb_accuracy"] = q["accuracy"] = with_(*NB) + acc
    tfidf_nb = (idf(), weights(),
        """wsums AS (SELECT v.term, c.label, coalesce(s.s, 0) AS s
  FROM vocab v CROSS JOIN (SELECT DISTINCT label FROM docs) c
  LEFT JOIN (SELECT w.term, w.label, sum(w.w) AS s FROM w JOIN train USING (doc_id)
             GROUP BY w.term, w.label) s ON s.term = v.term AND s.label = c.label)""",
        """wll AS (SELECT term, label, ln((s + 1) / (sum(s) OVER (PARTITION BY label)
    + count(*) OVER (PARTITION BY label))) AS ll FROM wsums)""",
        """wlp AS (SELECT d.doc_id, d.label, p.label AS class, p.lp + coalesce(sum(w.w * wll.ll), 0) AS lp
  FROM split d CROSS JOIN priors p LEFT JOIN w ON w.doc_id = d.doc_id
  LEFT JOIN wll ON wll.term = w.term AND wll.label = p.label
  WHERE d.is_test GROUP BY d.doc_id, d.label, p.label, p.lp)""",
        """wpred AS (SELECT doc_id, label, class AS prediction FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY lp DESC, class) AS rn FROM wlp) WHERE rn = 1)""",
        """both_ AS (SELECT 'bow' AS input, label, prediction FROM pred
  UNION ALL SELECT 'tfidf', label, prediction FROM wpred)""")
    q["nb_compare_inputs"] = with_(*NB, *tfidf_nb, prf("both_", "input"),
        f"f AS ({weighted('input')})") + """SELECT input, f1,
row_number() OVER (ORDER BY f1 DESC, input DESC) = 1 AS best FROM f"""
    alphas = " UNION ALL ".join(f"SELECT CAST({a} AS DOUBLE) AS alpha" for a in ALPHAS)
    q["nb_alpha_sweep"] = with_(*NB, f"alphas AS ({alphas})",
        """all_ AS (SELECT alpha, term, label, ln((s + alpha) / (sum(s) OVER (PARTITION BY alpha, label)
   + alpha * count(*) OVER (PARTITION BY alpha, label))) AS ll FROM sums CROSS JOIN alphas)""",
        """alp AS (SELECT a.alpha, d.doc_id, d.label, p.label AS class, p.lp + coalesce(sum(tf.tf * x.ll), 0) AS lp
  FROM split d CROSS JOIN priors p CROSS JOIN alphas a LEFT JOIN tf ON tf.doc_id = d.doc_id
  LEFT JOIN all_ x ON x.term = tf.term AND x.label = p.label AND x.alpha = a.alpha
  WHERE d.is_test GROUP BY a.alpha, d.doc_id, d.label, p.label, p.lp)""",
        """apred AS (SELECT alpha, label, class AS prediction FROM (SELECT *, row_number() OVER (
   PARTITION BY alpha, doc_id ORDER BY lp DESC, class) AS rn FROM alp) WHERE rn = 1)""",
        prf("apred", "alpha"), f"f AS ({weighted('alpha')})") + """
SELECT *, row_number() OVER (ORDER BY f1 DESC, alpha) = 1 AS best FROM f"""

    q["per_class_prf"] = with_(*NB, prf()) + """SELECT class, round("precision", 6) AS "precision",
round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM prf"""
    q["weighted_prf"] = with_(*NB, prf()) + weighted()
    cls = "(SELECT unnest([" + ", ".join(lit(c) for c in CLASSES) + "]) AS c)"
    q["confusion_matrix"] = with_(*NB) + f"""SELECT a.c AS label, b.c AS prediction, count(pred.doc_id) AS n
FROM {cls} a CROSS JOIN {cls} b LEFT JOIN pred ON pred.label = a.c AND pred.prediction = b.c GROUP BY ALL"""
    q["classification_report"] = with_(*NB, prf()) + """
SELECT class, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM prf
UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6),
  round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM prf
UNION ALL SELECT 'macro avg', round(avg("precision"), 6), round(avg(recall), 6), round(avg(f1), 6),
  CAST(sum(support) AS BIGINT) FROM prf
UNION ALL SELECT 'weighted avg', round(sum("precision" * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
  CAST(sum(support) AS BIGINT) FROM prf"""
    q["roc_points"] = with_(*NB, SCORE_GROUPS) + """SELECT class, round(score, 6) AS threshold,
round(sum(neg) OVER d / sum(neg) OVER (PARTITION BY class), 6) AS fpr,
round(sum(pos) OVER d / sum(pos) OVER (PARTITION BY class), 6) AS tpr
FROM groups WINDOW d AS (PARTITION BY class ORDER BY score DESC ROWS UNBOUNDED PRECEDING)"""
    auc = """aucs AS (SELECT class, sum(pos * (under + neg / 2)) / (sum(pos) * sum(neg)) AS auc,
  CAST(sum(pos) AS BIGINT) AS support FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY class ORDER BY score
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS under FROM groups) GROUP BY class)"""
    q["auc_ovr"] = with_(*NB, SCORE_GROUPS, auc) + "SELECT class, round(auc, 6) AS auc, support FROM aucs"
    q["weighted_auc"] = with_(*NB, SCORE_GROUPS, auc) + \
        "SELECT round(sum(auc * support) / sum(support), 6) AS roc_auc FROM aucs"
    q["misclassified"] = with_(*NB) + "SELECT doc_id, label, prediction FROM pred WHERE label <> prediction"
    q["misclassified_share"] = with_(*NB) + """SELECT count(*) AS total,
count(*) FILTER (WHERE label <> prediction) AS misclassified,
round(count(*) FILTER (WHERE label <> prediction) * 100.0 / count(*), 6) AS pct FROM pred"""
    why = """CASE WHEN length(text_clean) < 50 THEN 'SHORT_TEXT'
  WHEN pred.label = 'Satire' OR prediction = 'Satire' THEN 'SATIRE_CONFUSION'
  WHEN pred.label = 'Real' AND prediction = 'Fake' THEN 'SENSATIONAL_REAL'
  WHEN pred.label = 'Fake' AND prediction = 'Real' THEN 'FORMAL_FAKE' ELSE 'TOPIC_OVERLAP' END"""
    errs = f"""errs AS (SELECT pred.doc_id, pred.label, prediction, {why} AS category
  FROM pred JOIN cleaned ON cleaned.doc_id = pred.doc_id WHERE pred.label <> prediction)"""
    q["categorize_errors"] = with_(*NB, errs) + "SELECT * FROM errs"
    q["error_category_counts"] = with_(*NB, errs) + """SELECT category, count(*) AS n,
round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct
FROM (SELECT * FROM errs ORDER BY doc_id LIMIT 30) GROUP BY category"""
    return q
