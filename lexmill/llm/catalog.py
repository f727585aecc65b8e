"""Registered queries of this subpackage and the SQL of those SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexmill.llm import (ann, chunk_dedup, decontaminate, divergence, html_mincut, licenses, packing, passages,
                         quality, simhash_dedup, token_alignment, token_rollup, toxicity)
from lexmill.llm.shared import table
from lexmill.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash_near_dedup(spark, base):
    groups = simhash_dedup.near_duplicates(table(spark, base, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                         "component_id")


@query
def op2_toxicity_chain(spark, base):
    docs = table(spark, base, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, base, "labels")))


@query
def op3_nearest_vectors(spark, base):
    return ann.nearest(table(spark, base, "embeddings"))


@query
def op4_quality_rules(spark, base):
    docs = table(spark, base, "documents")
    return quality.scored(docs, quality.fit(docs, table(spark, base, "labels")))


@query
def op5_license_scan(spark, base):
    return licenses.scan(table(spark, base, "documents"))


@query
def op6_packing(spark, base):
    return packing.pack(table(spark, base, "documents"))


@query
def op7_token_rollup(spark, base):
    """All documents come in, those labelled low quality go, those labelled
    toxic lose their first line; the first batch is sent twice.  Joins meet the
    narrow changes, so no text is shuffled (an inner join with distinct ids is
    not pushed below the counting, as a semi-join would be)."""
    docs, labels = table(spark, base, "documents"), table(spark, base, "labels")
    low = labels.filter(F.col("quality") == 0).select("doc_id").distinct()
    toxic = labels.filter((F.col("toxic") == 1) & (F.col("quality") != 0)).select("doc_id").distinct()
    rest = docs.withColumn("rest", F.expr("substring(text, locate('\n', text) + 1)"))
    rollup = token_rollup.Rollup(spark, f"{shared_folder(spark)}/rollup_{uuid.uuid4().hex}")
    rollup.commit("load", token_rollup.inserts(docs))
    rollup.commit("low-quality", token_rollup.deletes(docs, ["doc_id"]).join(low, "doc_id"))
    rollup.commit("load", token_rollup.inserts(docs))
    rollup.commit("first-lines", token_rollup.revisions(rest, "rest", ["doc_id"]).join(toxic, "doc_id"))
    return rollup.totals()


SQL["op7_token_rollup"] = r"""
WITH changes AS (
  SELECT source, lang, text, CAST(1 AS BIGINT) AS sign, CAST(1 AS BIGINT) AS docs FROM documents
  UNION ALL
  SELECT source, lang, text, -1, -1 FROM documents
  WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 0)
  UNION ALL
  SELECT source, lang, text, -1, 0 FROM documents
  WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND quality <> 0)
  UNION ALL
  SELECT source, lang, substr(text, instr(text, chr(10)) + 1), 1, 0 FROM documents
  WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND quality <> 0)
), counted AS (
  SELECT source, lang, docs, sign, 'words-1' AS tokenizer,
         len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS tokens FROM changes
  UNION ALL
  SELECT source, lang, docs, sign, 'pieces-1',
         len(regexp_extract_all(coalesce(text, ''), '\p{L}+|\p{N}|[^\p{L}\p{N} \t\n\x0B\f\r]')) FROM changes
)
SELECT source, lang, tokenizer, CAST(sum(docs) AS BIGINT) AS docs, CAST(sum(sign * tokens) AS BIGINT) AS tokens
FROM counted GROUP BY source, lang, tokenizer
"""


@query
def op8_html_main_text(spark, base):
    return html_mincut.extract(table(spark, base, "pages"))


@query
def op9_repeated_passages(spark, base):
    spans = passages.repeated_passages(table(spark, base, "documents"))
    return spans.drop("row").distinct()


@query
def op10_benchmark_decontamination(spark, base):
    return decontaminate.contaminated(table(spark, base, "documents"), table(spark, base, "benchmark"))


@query
def op11_exact_dedup(spark, base):
    return chunk_dedup.exact_groups(table(spark, base, "documents"))


SQL["op11_exact_dedup"] = r"""
WITH texts AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents
), groups AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM texts JOIN groups USING (norm)
"""


@query
def op12_token_alignment(spark, base):
    found = token_alignment.aligned(table(spark, base, "documents"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def op13_source_divergence(spark, base):
    return divergence.audit(table(spark, base, "documents"))


SQL["op13_source_divergence"] = r"""
WITH texts AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents
), kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(words)) AS term FROM texts)
  GROUP BY lang, term HAVING count(*) >= 10
), sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang
), sources AS (SELECT DISTINCT lang, source FROM texts
), counted AS (
  SELECT lang, source, term, count(*) AS n
  FROM (SELECT lang, source, unnest(words) AS term FROM texts) JOIN kept USING (lang, term) GROUP BY ALL
), cells AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n
  FROM sources s JOIN kept k USING (lang) LEFT JOIN counted c USING (lang, source, term)
), shares AS (
  SELECT lang, source, term, n, 1 + CAST(1000000000 AS HUGEINT) * (n + 2)
         // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p FROM cells JOIN sizes USING (lang)
), whole AS (
  SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (n + 2) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM cells GROUP BY lang, term) JOIN sizes USING (lang)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(any_value(f), 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS f
             FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) d
    ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
  GROUP BY ALL
), best AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
         row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM pairs
  UNION ALL
  SELECT * FROM (SELECT lang, source, 'term', item, value,
         row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM best)
  WHERE rank <= 10
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked
"""
