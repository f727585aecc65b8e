"""Every registered query that has SQL, against its SQL on small tables.

The language-model queries hold out 100 documents, more than the smallest tables
have, so they run on the next larger ones.
"""

import os

import pytest

import __spark_entry__ as entry
from checks.compare import connect, rows_of

BASE, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
QUERIES, SQL = entry.queries(), entry.oracle_sql()
HELD_OUT = ("lm_prob", "perplexity", "classify_by_perplexity", "lm_evaluation")

pytestmark = pytest.mark.skipif(not os.path.isdir(BASE), reason="tables not present")


@pytest.fixture(scope="module")
def ducks():
    return {base: connect(base) for base in (BASE, LARGER)}


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_same_rows(spark, ducks, name):
    base = LARGER if name.startswith(HELD_OUT) else BASE
    df = QUERIES[name](spark, base)
    relation = ducks[base].execute(SQL[name])
    names = [d[0] for d in relation.description]
    want = relation.fetchall()
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark):
    text = plan(QUERIES["class_distribution"](spark, BASE))
    assert "ReadSchema: struct<doc_id:bigint>" in text and "text:string" not in text


def test_term_counts_shuffle_documents_once(spark):
    text = plan(QUERIES["term_counts"](spark, BASE))
    assert text.count("Exchange hashpartitioning") == 1


def test_prepared_table_is_read_without_a_shuffle(spark):
    from lexmill.operators import bow as B
    from lexmill.plans.tables import prepared_documents
    text = plan(B.term_counts(prepared_documents(spark, BASE)))
    assert "Bucketed: true" in text and "Exchange hashpartitioning" not in text


def test_top_k_is_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["top_terms_per_class"](spark, BASE))
