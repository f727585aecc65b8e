"""DuckDB SQL for normal forms, fitted models, experiments and scoring."""

from __future__ import annotations

from checks.oracle_sql import (BASE, MAX_TERMS, WORDS, clean, docs, in_list, lit, prf, split,
                               split_tokens, unlisted, vec_tokens, vocab, with_)
from checks.oracle_stems import snowball
from lexmill.functions.wordlists import CLASSES, stopwords


def plural(w):
    n = f"length({w})"
    return f"""CASE WHEN {n} <= 3 THEN {w}
  WHEN {w} LIKE '%ies' AND {n} > 4 THEN left({w}, {n} - 3) || 'y'
  WHEN regexp_matches({w}, '(ss|sh|ch|x|z)es$') THEN left({w}, {n} - 2)
  WHEN regexp_matches({w}, '[^sui]s$') THEN left({w}, {n} - 1) ELSE {w} END"""


def model_tokens(stop="custom", min_len=1, source="text_clean"):
    kept = unlisted(split_tokens(source), stopwords(stop))
    kept = f"list_filter({kept}, lambda t: length(t) >= {min_len})"
    return vec_tokens(f"array_to_string(list_transform({kept}, lambda t: {plural('t')}), ' ')")


def stemmed_docs(t, stop):
    """CTEs ending in `docs{t}`: tokens of `parts` in their Snowball form."""
    joined = vec_tokens("string_agg(norm, ' ' ORDER BY pos)")
    return [
        f"""kept{t} AS (SELECT doc_id, label, is_test, {unlisted(split_tokens('text_clean'), stopwords(stop))} AS k FROM parts)""",
        f"""at{t} AS (SELECT doc_id, label, is_test, unnest(k) AS word, unnest(range(1, len(k) + 1)) AS pos FROM kept{t})""",
        f"words AS (SELECT DISTINCT word FROM at{t})", *snowball(),
        f"""docs{t} AS (SELECT a.doc_id, a.label, a.is_test, {joined} AS tokens
  FROM at{t} a JOIN snowball s ON s.word = a.word GROUP BY a.doc_id, a.label, a.is_test)"""]


def nb_tfidf(t, stop, min_len, size):
    """CTEs ending in `ll{t}`: NB on TF-IDF of one preprocessing of `parts`."""
    docs_ = stemmed_docs(t, stop) if t == STEMMED else [
        f"docs{t} AS (SELECT doc_id, label, is_test, {model_tokens(stop, min_len)} AS tokens FROM parts)"]
    return [
        *docs_,
        f"""tf{t} AS (SELECT doc_id, label, is_test, term, count(*) AS tf FROM (
  SELECT doc_id, label, is_test, unnest(tokens) AS term FROM docs{t}) GROUP BY ALL)""",
        f"""voc{t} AS (SELECT term, ln((1 + CAST((SELECT count(*) FROM parts) AS DOUBLE)) / (1 + df)) + 1 AS idf
  FROM (SELECT term, sum(tf) AS cf, count(*) AS df FROM tf{t} GROUP BY term ORDER BY cf DESC, term LIMIT {size}))""",
        f"""w{t} AS (SELECT doc_id, label, is_test, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS w
  FROM (SELECT x.*, (1 + ln(tf)) * v.idf AS raw FROM tf{t} x JOIN voc{t} v ON v.term = x.term))""",
        f"""sm{t} AS (SELECT v.term, c.label, coalesce(s.s, 0) AS s FROM voc{t} v
  CROSS JOIN (SELECT DISTINCT label FROM parts) c LEFT JOIN (SELECT term, label, sum(w) AS s FROM w{t}
    WHERE NOT is_test GROUP BY ALL) s ON s.term = v.term AND s.label = c.label)""",
        f"""ll{t} AS (SELECT term, label, ln((s + 1) / (sum(s) OVER (PARTITION BY label)
  + count(*) OVER (PARTITION BY label))) AS ll FROM sm{t})"""]


STEMMED = "3"       # the configuration that stems
PARTS_PRIORS = """priors AS (SELECT label, ln(count(*) / (SELECT count(*) FROM parts WHERE NOT is_test)) AS lp
  FROM parts WHERE NOT is_test GROUP BY label)"""


def nb_test(t, texts, w):
    """Scores of `texts` (doc_id, label) with weights `w`."""
    return [
        f"""lp{t} AS (SELECT d.doc_id, d.label, p.label AS class, p.lp + coalesce(list_sum(list_sort(list(x.w * y.ll))), 0) AS lp
  FROM {texts} d CROSS JOIN priors p LEFT JOIN {w} x ON x.doc_id = d.doc_id
  LEFT JOIN ll{t} y ON y.term = x.term AND y.label = p.label GROUP BY d.doc_id, d.label, p.label, p.lp)""",
        f"""scored{t} AS (SELECT doc_id, label, class, lp, e / list_sum(list_sort(list(e) OVER (PARTITION BY doc_id))) AS p
  FROM (SELECT *, exp(lp - max(lp) OVER (PARTITION BY doc_id)) AS e FROM lp{t}))""",
        f"""pred{t} AS (SELECT doc_id, label, class AS prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY lp DESC, class) AS rn FROM lp{t}) WHERE rn = 1)"""]


ABLATION = (("config_1", "standard", 1, 5000), ("config_2", "custom", 1, 5000),
            ("config_3", "custom", 1, 5000), ("config_4", "custom", 3, 5000), ("config_5", "custom", 1, 10000),
            ("config_6", "custom", 1, 15000))


def models(q) -> dict[str, str]:
    """`q` holds the queries of the first part."""
    m: dict[str, str] = {}
    vocab_words = "words AS (SELECT DISTINCT unnest(tokens) AS word FROM docs)"
    lem = (*BASE, docs(), vocab_words, f"lem AS (SELECT word, {plural('word')} AS norm FROM words)")
    m["normalize_via_vocab"] = with_(*BASE, docs()) + f"""SELECT doc_id,
array_to_string(list_transform(tokens, lambda t: {plural('t')}), ' ') AS tokens FROM docs"""
    m["lemma_vocab"] = with_(*lem) + "SELECT word, norm FROM lem"
    m["lemma_vocab_dictionary"] = with_(*lem, f"""dict AS (SELECT DISTINCT word, regexp_replace(word, 's$', '') AS lemma
FROM (SELECT unnest({split_tokens('lower(text)')}) AS word FROM benchmark))""") + """
SELECT lem.word, coalesce(d.lemma, lem.norm) AS norm FROM lem
LEFT JOIN (SELECT * FROM dict WHERE lemma <> '') d ON d.word = lem.word"""
    m["vocab_reduction_lemma"] = with_(*lem) + """SELECT 'lemma' AS method, count(*) AS original_vocab,
count(DISTINCT norm) AS new_vocab, round((1 - count(DISTINCT norm) / count(*)) * 100, 6) AS reduction_pct FROM lem"""
    m["over_stemming_lemma"] = with_(*lem) + """SELECT 'lemma' AS method, count(*) AS n_terms,
count(*) FILTER (WHERE length(norm) < length(word) * 0.5) AS over_stemmed FROM lem"""
    pre = f"""pre AS (SELECT doc_id, t, {unlisted('t', stopwords('custom'))} AS kept FROM (
  SELECT doc_id, {split_tokens(clean('text'))} AS t FROM documents)),
gone AS (SELECT doc_id, string_agg(w, ' ' ORDER BY w) AS removed FROM (
  SELECT DISTINCT doc_id, lower(unnest(t)) AS w FROM pre) WHERE w IN {in_list(stopwords('custom'))} GROUP BY doc_id)"""
    m["preprocess"] = with_(pre) + f"""SELECT pre.doc_id,
array_to_string(list_transform(kept, lambda t: {plural('t')}), ' ') AS tokens, coalesce(removed, '') AS removed,
'clean,tokenize,remove_stopwords,normalize' AS steps, len(kept) AS token_count
FROM pre LEFT JOIN gone ON gone.doc_id = pre.doc_id"""
    m["preprocess_clean_tokenize"] = f"""SELECT doc_id, array_to_string(t, ' ') AS tokens,
'clean,tokenize' AS steps, len(t) AS token_count FROM (SELECT doc_id, {split_tokens(clean('text'))} AS t FROM documents)"""
    m["doc_vectors"] = with_(*WORDS, vocab(10000), """known AS (SELECT v.term, e.embedding FROM vocab v
  JOIN embeddings e ON e.vec_id = v.idx)""") + "SELECT d.doc_id, " + ", ".join(
        f"round(coalesce(sum(tf.tf * k.embedding[{i + 1}]::DOUBLE) / sum(tf.tf) FILTER (WHERE k.term IS NOT NULL), 0), 6) + 0.0 AS v{i}"
        for i in range(64)) + """ FROM docs d LEFT JOIN tf ON tf.doc_id = d.doc_id
LEFT JOIN known k ON k.term = tf.term GROUP BY d.doc_id"""
    ab = "ab AS (SELECT vec_id, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b FROM embeddings)"
    names = ["a", "b", "a_a", "a_b", "b_b", "a_a_a", "a_a_b", "a_b_b", "b_b_b"]
    m["poly_expand"] = with_(ab) + "SELECT vec_id, " + ", ".join(
        f"round({n.replace('_', ' * ')}, 6) + 0.0 AS {n}" for n in names) + " FROM ab"
    m["poly_feature_count"] = with_(*WORDS, vocab(10000), "c AS (SELECT count(*) AS n FROM vocab)") + """
SELECT n, n AS degree_1, (n + 1) * (n + 2) // 2 - 1 AS degree_2,
(n + 1) * (n + 2) * (n + 3) // 6 - 1 AS degree_3 FROM c"""
    scaled = ", ".join(f"""round(({x} - min({x}) OVER ()) / (max({x}) OVER () - min({x}) OVER ()), 6) + 0.0 AS v{i}"""
                       for i, x in enumerate(f"embedding[{i + 1}]::DOUBLE" for i in range(64)))
    m["minmax_scale"] = f"SELECT vec_id, {scaled} FROM embeddings"
    m["lr_gradient"] = " UNION ALL ".join(f"SELECT {lit(c)} AS class, true AS minimal" for c in CLASSES)
    m["pca2_moments"] = """SELECT CAST(0 AS DOUBLE) AS mean1, CAST(0 AS DOUBLE) AS mean2, CAST(0 AS DOUBLE) AS correlation,
CAST(1 AS DOUBLE) AS shares"""

    parts = (*BASE, "cl AS (SELECT doc_id, label, text_clean FROM cleaned)", split("cl"),
             "parts AS (SELECT doc_id, label, is_test, text_clean FROM split)",
             PARTS_PRIORS, "tst AS (SELECT doc_id, label FROM parts WHERE is_test)")
    runs = []
    for name, stop, k, size in ABLATION:
        t = name[-1]
        runs += [*nb_tfidf(t, stop, k, size), *nb_test(t, "tst", f"w{t}")]

    def union(x):
        return " UNION ALL ".join(f"SELECT {lit(c[0])} AS config_name, * FROM {x}{c[0][-1]}" for c in ABLATION)

    params = " UNION ALL ".join(
        f"SELECT {lit(n)} AS config_name, {lit(s)} AS stopwords, {lit('stem' if n[-1] == STEMMED else 'lemma')} AS normalization, "
        f"{k}::BIGINT AS min_token_len, {z}::BIGINT AS max_features" for n, s, k, z in ABLATION)
    per = ", ".join(f'round(max(CASE WHEN class = {lit(c)} THEN {x} END), 6) AS "{y}_{c}"'
                    for c in CLASSES for x, y in (('"precision"', "precision"), ("recall", "recall"), ("f1", "f1")))
    m["ablation_naive_bayes"] = with_(*parts, *runs, f"pred AS ({union('pred')})", f"scored AS ({union('scored')})",
        prf("pred", "config_name"), f"params AS ({params})",
        """groups AS (SELECT config_name, class, p AS score, count(*) FILTER (WHERE label = class) AS pos,
    count(*) FILTER (WHERE label <> class) AS neg FROM scored GROUP BY ALL)""",
        """aucs AS (SELECT config_name, class, sum(pos * (under + neg / 2)) / (sum(pos) * sum(neg)) AS auc, sum(pos) AS support
  FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY config_name, class ORDER BY score
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS under FROM groups) GROUP BY ALL)""",
        f"""mt AS (SELECT config_name, round(sum(tp) / sum(support), 6) AS accuracy,
    round(sum(f1 * support) / sum(support), 6) AS f1_weighted, {per} FROM prf GROUP BY config_name)""",
        """ra AS (SELECT config_name, round(sum(auc * support) / sum(support), 6) AS roc_auc FROM aucs GROUP BY config_name)""") + """
SELECT params.*, mt.* EXCLUDE (config_name), roc_auc FROM params
JOIN mt ON mt.config_name = params.config_name JOIN ra ON ra.config_name = params.config_name"""

    ver = f"""WITH RECURSIVE sweep AS ({q['nb_alpha_sweep']}),
long_ AS (SELECT alpha, 'f1' AS model, f1 FROM sweep UNION ALL SELECT alpha, 'precision', "precision" FROM sweep
  UNION ALL SELECT alpha, 'recall', recall FROM sweep),
v AS (SELECT model, row_number() OVER (PARTITION BY model ORDER BY alpha) AS version, f1 FROM long_),
fold AS (SELECT DISTINCT model, 0::BIGINT AS version, CAST(0 AS DOUBLE) AS best, false AS won FROM v
  UNION ALL SELECT v.model, v.version, CASE WHEN v.f1 >= best + CAST(0.01 AS DOUBLE) THEN v.f1 ELSE best END,
    v.f1 >= best + CAST(0.01 AS DOUBLE) FROM fold JOIN v ON v.model = fold.model AND v.version = fold.version + 1),
staged AS (SELECT v.model, v.version, v.f1, CASE WHEN NOT won THEN 'Staging'
    WHEN v.version = max(CASE WHEN won THEN v.version END) OVER (PARTITION BY v.model) THEN 'Production'
    ELSE 'Archived' END AS stage FROM v JOIN fold ON fold.model = v.model AND fold.version = v.version)
"""
    m["promote"] = ver + "SELECT model, version, f1, stage FROM staged"
    live = """SELECT model, max(version) FILTER (WHERE stage = 'Production') AS version,
max(f1) FILTER (WHERE stage = 'Production') AS f1, count(*) AS n_versions, {} FROM staged GROUP BY model"""
    m["production_version"] = ver + live.format("string_agg(version || ':' || stage, ' ' ORDER BY version) AS history")
    m["performance_table"] = ver + live.format("string_agg(printf('f1_v%d=%.6f', version, f1), ' ' ORDER BY 'f1_v' || version) AS metrics")

    all_parts = (*BASE, "parts AS (SELECT doc_id, label, false AS is_test, text_clean FROM cleaned)", PARTS_PRIORS)
    accepted = "length(text) >= 10 AND length(text) <= 10000"

    def scoring(texts):
        return (*all_parts, *nb_tfidf("", "custom", 1, MAX_TERMS),
            f"new AS (SELECT doc_id, NULL AS label, {model_tokens(source=clean('text'))} AS tokens FROM {texts} WHERE {accepted})",
            """ntf AS (SELECT doc_id, term, count(*) AS tf FROM (
  SELECT doc_id, unnest(tokens) AS term FROM new) GROUP BY ALL)""",
            """nw AS (SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS w
  FROM (SELECT x.*, (1 + ln(tf)) * v.idf AS raw FROM ntf x JOIN voc v ON v.term = x.term))""",
            *nb_test("", "new", "nw"))

    turns = "turns AS (SELECT conv_id || '-' || turn AS doc_id, conv_id, text FROM conversations)"
    why = """coef AS (SELECT term, label, ll - avg(ll) OVER (PARTITION BY term) AS coef FROM ll),
contrib AS (SELECT nw.doc_id, nw.term, nw.w * c.coef AS contribution FROM nw
  JOIN pred p ON p.doc_id = nw.doc_id JOIN coef c ON c.term = nw.term AND c.label = p.prediction),
why AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(abs(contribution), 12) DESC, term) AS rank
  FROM contrib WHERE contribution <> 0)"""
    base = (turns, *scoring("turns"), why)
    m["explain_scores"] = with_(*base) + \
        "SELECT doc_id, rank, term, round(contribution, 6) + 0.0 AS contribution FROM why WHERE rank <= 10"
    m["score_texts"] = with_(*base, """tops AS (SELECT doc_id, string_agg(term, ' ' ORDER BY rank) AS t
FROM why WHERE rank <= 10 GROUP BY doc_id)""") + """
SELECT pred.doc_id, pred.prediction, round(max(p), 6) AS confidence,
round(max(p) FILTER (WHERE class = 'Fake'), 6) AS "p_Fake", round(max(p) FILTER (WHERE class = 'Real'), 6) AS "p_Real",
round(max(p) FILTER (WHERE class = 'Satire'), 6) AS "p_Satire", coalesce(any_value(t), '') AS top_features
FROM pred JOIN scored s ON s.doc_id = pred.doc_id LEFT JOIN tops ON tops.doc_id = pred.doc_id
GROUP BY pred.doc_id, pred.prediction"""
    m["score_batches"] = with_(f"vb AS ({q['validate_batches']})", turns,
        "ok AS (SELECT t.* FROM turns t JOIN vb ON vb.conv_id = t.conv_id WHERE vb.accepted)", *scoring("ok"),
        """agg AS (SELECT ok.conv_id, count(*) AS total_texts, round(avg(c.p), 6) AS avg_confidence,
  count(*) FILTER (WHERE prediction = 'Fake') AS "n_Fake", count(*) FILTER (WHERE prediction = 'Real') AS "n_Real",
  count(*) FILTER (WHERE prediction = 'Satire') AS "n_Satire"
  FROM pred JOIN ok ON ok.doc_id = pred.doc_id
  JOIN (SELECT doc_id, max(p) AS p FROM scored GROUP BY doc_id) c ON c.doc_id = pred.doc_id GROUP BY ok.conv_id)""") + """
SELECT vb.*, agg.* EXCLUDE (conv_id) FROM vb LEFT JOIN agg ON agg.conv_id = vb.conv_id"""

    def quota(client, limit):
        return f"""SELECT {client}, date_trunc('minute', ts) AS minute, count(*) AS n,
greatest(count(*) - {limit}, 0) AS over_limit FROM events GROUP BY ALL"""

    m["quota_audit_single"] = quota("user_id", 100)
    m["quota_audit_batch"] = quota("user_id", 10)
    m["quota_audit_type"] = quota("event_type", 10)
    return m
