"""DuckDB SQL for readers, sinks, versions, logs, runs and streams."""

from __future__ import annotations

from checks.oracle_sql import (BASE, CORPUS, MAX_TERMS, RATED, WORDS, clean, docs, idf, stopwords, unlisted,
                               vec_tokens, vocab, weights, with_)


def sources(q: dict[str, str]) -> dict[str, str]:
    """`q` holds the queries of the other parts."""
    s: dict[str, str] = {}
    s["read_statements_tsv"] = with_(RATED) + r"""SELECT doc_id, rating AS label,
md5(trim(regexp_replace(text, '[\s\v\p{Z}]+', ' ', 'g'))) AS text_md5 FROM mapped"""
    s["read_titles_csv"] = with_(CORPUS) + """SELECT doc_id, label, md5(text) AS text_md5 FROM corpus
WHERE label IN ('Real', 'Fake')"""
    s["read_headlines_json"] = with_(CORPUS) + """SELECT doc_id, CAST(label = 'Fake' AS BIGINT) AS is_sarcastic,
md5(text) AS text_md5 FROM corpus"""
    s["write_corpus"] = with_(CORPUS) + """SELECT doc_id, label, md5(text) AS parquet_md5, md5(text) AS csv_md5 FROM corpus"""
    s["assemble_corpus"] = with_(RATED, """parts AS (
  SELECT doc_id * 3 AS doc_id, text, mapped_label AS label, 'statements' AS source, rating AS original_label FROM mapped
  UNION ALL SELECT d.doc_id * 3 + 1, d.text, 'Satire', 'headlines', 'Satire' FROM documents d
    JOIN labels l ON l.doc_id = d.doc_id WHERE l.toxic = 1
  UNION ALL SELECT d.doc_id * 3 + 2, d.text, CASE WHEN l.quality = 1 THEN 'Real' ELSE 'Fake' END, 'titles',
    CASE WHEN l.quality = 1 THEN 'Real' ELSE 'Fake' END FROM documents d
    JOIN labels l ON l.doc_id = d.doc_id WHERE l.toxic = 0)""",
        """capped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, label ORDER BY md5('42:' || doc_id)) AS rn
  FROM parts WHERE label IS NOT NULL AND text IS NOT NULL)
  WHERE rn <= CASE source WHEN 'statements' THEN 2000 WHEN 'titles' THEN 1500 ELSE 3000 END)""",
        "kept AS (SELECT * FROM capped WHERE doc_id IN (SELECT min(doc_id) FROM capped GROUP BY text))",
        "sizes AS (SELECT label, count(*) AS n FROM kept GROUP BY label)",
        "whole AS (SELECT sum(n) AS total, count(*) AS k, max(n) / sum(n) > 0.4 AS act FROM sizes)") + """
SELECT doc_id, kept.label, source, original_label,
round(CASE WHEN act THEN total / (k * n) ELSE 1.0 END, 6) AS sample_weight
FROM kept JOIN sizes ON sizes.label = kept.label CROSS JOIN whole"""
    s["raw_manifest"] = """SELECT item_id, strlen(text) + 1 AS file_size_bytes, md5(text || chr(10)) AS md5_hash,
'benchmark' AS source FROM benchmark"""
    s["write_version"] = with_(CORPUS) + "SELECT doc_id, label, md5(text) AS text_md5 FROM corpus"
    s["read_version"] = s["write_version"] + " WHERE label = 'Real'"
    s["list_versions"] = with_(CORPUS) + """SELECT 'v2' AS version, count(*) AS n FROM corpus
UNION ALL SELECT 'v10', count(*) FROM corpus WHERE label = 'Real'"""
    s["write_word_vectors"] = """SELECT vec_id AS word,
array_to_string(list_transform(embedding, lambda x: printf('%.6f', x)), ' ') AS vector FROM embeddings"""
    s["model_tables"] = q["nb_fit"]
    state = (*BASE, docs(), f"""final AS (SELECT doc_id, label, tokens FROM docs
  WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0 AND doc_id IS NOT NULL)
  UNION ALL SELECT -1 - item_id, 'Real', {unlisted(vec_tokens(clean('text')), stopwords('custom'))} FROM benchmark
  WHERE length({clean('text')}) > 0)""",
             "words AS (SELECT doc_id, label, unnest(tokens) AS word FROM final)",
             "edged AS (SELECT doc_id, label, list_concat(['<s>'], tokens, ['</s>']) AS p FROM final)",
             """pairs AS (SELECT doc_id, label, p[i] AS context, p[i + 1] AS word
  FROM (SELECT doc_id, label, p, unnest(range(1, len(p))) AS i FROM edged))""")
    s["refreshed_counts"] = with_(*state) + """
SELECT 'class' AS kind, label, '' AS context, '' AS word, count(*) AS n_docs, count(*) AS n FROM final GROUP BY label
UNION ALL SELECT 'term', label, '', word, count(DISTINCT doc_id), count(*) FROM words GROUP BY label, word
UNION ALL SELECT 'gram', label, context, word, count(DISTINCT doc_id), count(*) FROM pairs GROUP BY label, context, word"""
    s["refreshed_vocabulary"] = with_(*state,
        """top AS (SELECT word AS term, count(*) AS cf, count(DISTINCT doc_id) AS df FROM words GROUP BY word
  ORDER BY cf DESC, term LIMIT 10000)""") + """SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx, cf, df,
round(ln((1 + CAST((SELECT count(*) FROM final) AS DOUBLE)) / (1 + df)) + 1, 6) AS idf FROM top"""
    s["sketch_errors"] = """SELECT event_type, count(*) AS n, 1 AS distinct_within, 1 AS p50_within, 1 AS p95_within,
1 AS halves_equal FROM events GROUP BY event_type"""
    log = """log AS (SELECT date_trunc('second', ts) AS ts, 'INFO' AS level, 'RESPONSE' AS kind, 'POST' AS method,
  '/' || event_type AS path, CASE WHEN t % 10 = 0 THEN 422 ELSE 200 END AS status, t / 10 AS ms
  FROM (SELECT *, CAST(floor(abs(value) * 10) AS BIGINT) AS t FROM events))"""
    s["read_request_log"] = with_(log) + "SELECT ts, level, kind, method, path, status, round(ms, 6) AS ms FROM log"
    s["request_summary"] = with_(log) + """SELECT path, status, count(*) AS n,
round(avg(CASE WHEN status >= 400 THEN 1.0 ELSE 0.0 END), 6) AS error_share, round(avg(ms), 6) AS mean_ms,
round(quantile_cont(ms, 0.5), 6) AS p50_ms, round(quantile_cont(ms, 0.95), 6) AS p95_ms FROM log GROUP BY path, status"""
    runs = f"""WITH sweep AS ({q['nb_alpha_sweep']}),
r AS (SELECT *, row_number() OVER (ORDER BY alpha) - 1 AS i FROM sweep)
"""
    s["read_runs"] = runs + """SELECT 'run' || i AS run_id, alpha || chr(10) || 'smoothing' AS alpha,
CAST(1000 * (i + 1) AS VARCHAR) AS max_features, accuracy, f1, CAST(2 AS BIGINT) AS ts FROM r"""

    def scaled(x):
        return f"""round(CASE WHEN max({x}) OVER () > min({x}) OVER ()
  THEN ({x} - min({x}) OVER ()) / (max({x}) OVER () - min({x}) OVER ()) ELSE 0.5 END, 6) + 0.0"""

    s["compare_runs"] = runs + f"""SELECT 'run' || i AS run_id, {scaled('i % 2')} AS stopwords,
{scaled('i % 3')} AS normalization, {scaled('i')} AS min_token_len, {scaled('i')} AS max_features,
{scaled('accuracy')} AS accuracy, {scaled('f1')} AS f1_weighted FROM r"""
    s["log_run"] = runs + "SELECT 'a' || alpha AS run_id, CAST(alpha AS VARCHAR) AS alpha, f1 FROM r"
    cards = """facts AS (SELECT source, count(*) AS n, count(DISTINCT lang) AS langs, avg(n_chars) AS mean
  FROM documents GROUP BY source),
cards AS (SELECT source, 'volume' AS criterion, least(n // 10, 5) AS score FROM facts
  UNION ALL SELECT source, 'variety', least(langs, 5) FROM facts
  UNION ALL SELECT source, 'length', CAST(least(floor(mean / 500), 5) AS BIGINT) FROM facts)"""
    s["scorecards"] = with_(cards) + "SELECT * FROM cards"
    s["scorecard_totals"] = with_(cards) + """SELECT source, CAST(sum(score) AS BIGINT) AS total,
CAST(25 AS BIGINT) AS out_of FROM cards GROUP BY source"""
    s["quota_stream"] = f"""SELECT * FROM ({q['quota_audit_batch']})
WHERE minute + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 2 MINUTE"""
    s["dedup_stream"] = "SELECT DISTINCT md5(text) AS text_md5 FROM conversations"
    s["score_stream"] = f"SELECT * EXCLUDE (top_features) FROM ({q['score_texts']})"
    s["count_vectors"] = q["term_counts"]
    dense = ", ".join(f"v{i}" for i in range(64))
    s["concat_features"] = with_(*WORDS, vocab(), idf(), weights()) + f"""SELECT doc_id, idx AS i, round(w, 6) AS value
FROM (SELECT w.doc_id, v.idx, w.w FROM w JOIN vocab v ON v.term = w.term)
UNION ALL SELECT doc_id, {MAX_TERMS} + CAST(substr(name, 2) AS BIGINT), value FROM (
  UNPIVOT ({q['doc_vectors']}) ON {dense} INTO NAME name VALUE value) WHERE value <> 0"""
    return s
