"""Per-document operators, packing, rollups and the pipeline."""

import itertools
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lexmill.llm import html_mincut, licenses, packing, quality, token_rollup, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, words string, at string"


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", "s", len(t or ""), "x", "y", "z") for i, t in rows], DOCS)


# --- quality ---------------------------------------------------------------------------

def texts(rng, n):
    rows, labels = [(9000, None), (9001, ""), (None, "Some text of no id.")], [(9000, None, 0), (77777, 1, 0)]
    for i in range(n):
        words = [f"word{rng.randrange(500)}" for _ in range(rng.randrange(20, 80))]
        bad = i % 3 == 0
        text = " ".join(w.upper() + "!!" for w in words) if bad else " ".join(words) + "."
        rows.append((i, text))
        labels.append((i, 0 if bad else 1, 0))
    return rows + [rows[5]], labels


def test_quality_learns_and_keeps_clean_documents(spark):
    rows, labels = texts(random.Random(1), 300)
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.fit(docs, marks)
    got = quality.scored(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    truth = {i: q for i, q, _ in labels}
    for r in got:
        if r.doc_id is not None and r.doc_id < 9000:
            assert r.predicted == truth[r.doc_id]
        assert r.predicted == int(r.score >= 0.3)
    kept = quality.accepted(docs, marks, model)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if r.predicted)


def test_held_out_rows_are_never_learned(spark):
    rows, labels = texts(random.Random(2), 200)
    import zlib
    docs = frame(spark, rows)
    flipped = [(i, 1 - q if q is not None and zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    fit = lambda x: quality.fit(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int"))
    a, b = fit(labels), fit(flipped)
    assert a.intercept == b.intercept and a.rules == b.rules


@pytest.mark.parametrize("given, want", [([], 1), ([(1, 0, 0), (2, 0, 0), (3, 0, 0)], 0)])
def test_quality_with_one_class(spark, given, want):
    docs = frame(spark, [(i, f"text {i}") for i in range(6)])
    model = quality.fit(docs, spark.createDataFrame(given, "doc_id long, quality int, toxic int"))
    assert {r.predicted for r in quality.scored(docs, model).collect()} == {want}


def test_statistics(spark):
    row = spark.createDataFrame([("Aa aa aa\n#1",), (None,)], "t string").select(
        quality.statistics(F.col("t")).alias("s")).collect()
    s, none = row[0].s, row[1].s
    assert (s.upper, s.symbols, s.digits) == (1 / 11, 1 / 11, 1 / 11)
    assert s.repeats == 0.25 and s.distinct == 0.75 and s.line_words == 2.0 and s.longest == 2
    assert none.words == 0 and none.longest == 0


# --- toxicity --------------------------------------------------------------------------

def test_toxicity_chain(spark):
    rng = random.Random(3)
    insults = ["fool", "dunce", "oaf", "ninny"]
    rows, labels = [(900, None), (901, ""), (None, "fool dunce oaf")], [(902, 1, 1)]
    for i in range(400):
        words = [f"w{rng.randrange(80)}" for _ in range(rng.randrange(10, 200))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randrange(1, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(insults))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    chain = toxicity.fit(docs, marks)
    got = toxicity.scored(docs, chain).collect()
    assert len(got) == len(rows)
    wrong = [r for r in got if r.doc_id is not None and r.doc_id < 400 and r.toxic != int(r.doc_id % 4 == 0)]
    assert len(wrong) <= 4
    assert [len(x) for x in chain.links] == [0, 1, 2]
    assert toxicity.CATEGORIES[-1] == "toxic" and all(abs(w) > 0.01 for w in chain.links[2])
    alone = toxicity.ToxicityChain(chain.index, chain.intercepts, chain.weights, [[], [0.0], [0.0, 0.0]])
    moved = [abs(alone.probabilities(t or "")[2] - chain.probabilities(t or "")[2]) for _, t in rows]
    assert max(moved) > 0.01
    clean = toxicity.ToxicityChain({}, [-1.0, 0.0, 0.0], chain.weights[:0], [[], [2.0], [0.0, 3.0]])
    p = clean.probabilities("")
    sigmoid = lambda z: 1 / (1 + 2.718281828459045 ** -z)
    assert p == pytest.approx([sigmoid(-1), sigmoid(2 * sigmoid(-1)), sigmoid(3 * sigmoid(2 * sigmoid(-1)))])


def test_equal_texts_of_different_labels_are_toxic_in_any_order(spark):
    rows = [(i, f"plain words {i % 7} here") for i in range(60)] + [(i, "you fool") for i in range(60, 120)]
    labels = [(i, 1, int(i == 101 or 100 <= i < 120 and i % 2)) for i in range(120)]
    found = []
    for order in (labels, labels[::-1]):
        marks = spark.createDataFrame(order, "doc_id long, quality int, toxic int")
        docs = frame(spark, rows if order is labels else rows[::-1])
        got = toxicity.scored(docs, toxicity.fit(docs, marks)).collect()
        found.append({r.doc_id: r.toxic for r in got})
    assert found[0] == found[1] and all(v == int(i >= 60) for i, v in found[0].items())


def test_toxicity_with_one_class_and_empty(spark):
    marks = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    docs = frame(spark, [(i, f"text {i}") for i in range(4)])
    assert {r.toxic for r in toxicity.scored(docs, toxicity.fit(docs, marks)).collect()} == {0}
    none = frame(spark, [])
    assert toxicity.scored(none, toxicity.fit(none, marks)).count() == 0


# --- licences --------------------------------------------------------------------------

def brute_dice(a, b):
    pairs = lambda t: set(zip(t, t[1:]))
    a, b = pairs(licenses.normal_words(a)), pairs(licenses.normal_words(b))
    return 2 * len(a & b) / (len(a) + len(b)) if a and b else 0.0


def test_licences_equal_brute_force(spark):
    rng = random.Random(4)
    rows = [(1, None), (2, ""), (None, "Released under the MIT License."), (3, "x"), (4, "the " * 3000)]
    for i in range(60):
        words = rng.choice(licenses.KNOWN)[1].split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = rng.choice(["other", "words", "the"])
        rows.append((10 + i, "plain first line here\n" + " ".join(words) + "\nlast line"))
    got = defaultdict(list)
    for r in licenses.scan(frame(spark, rows + rows[-1:])).collect():
        got[r.doc_id].append((r.part, r.line, r.licence, round(r.dice, 12)))
    for i, t in rows:
        want = []
        for n, line in enumerate((t or "").split("\n")):
            best = max((brute_dice(line, x) for _, x in licenses.KNOWN))
            if best >= 0.8:
                names = [name for name, x in licenses.KNOWN if brute_dice(line, x) == best]
                want.append((n, min(names), round(best, 12)))
        lines = [x[1:] for x in got[i] if x[0] == "line"]
        assert sorted(lines) == sorted(want * (2 if i == rows[-1][0] else 1))


def test_a_licence_over_several_lines(spark):
    mit = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 200)
    words = mit.split()
    text = "\n".join(" ".join(words[i:i + 12]) for i in range(0, len(words), 12))
    got = licenses.scan(frame(spark, [(1, text), (2, "Intro.\n\n" + text + "\n\nSome other words at the end.")])).collect()
    assert {(r.doc_id, r.licence) for r in got if r.part == "paragraph"} == {(1, "MIT"), (2, "MIT")}
    assert licenses.scan(frame(spark, [])).count() == 0


def test_notices_inside_longer_parts(spark):
    long = {n: t for n, t in licenses.TEMPLATES if len(t) > 200}
    prose = "these are words of plain prose beside the notice"
    rows = [(1, "Copyright 2020 Jane Doe. Licensed under the MIT License."),
            (2, "Copyright (c) 2020 Jane Doe. All rights reserved."),
            (3, f"{prose}\nand more {prose}. Licensed under CC BY-NC 4.0. {prose}"),
            (4, f"{long['Apache-2.0']}\nimport os\n" + "\n".join(f"x{i} = os.path.join(a{i}, b{i})" for i in range(40))),
            (5, f"MIT terms {prose} {long['MIT']} The software is provided as is, " + " ".join(f"word{i}" for i in range(80))),
            (6, f"{prose} licensed under the terms of all rights of some license {prose}")]
    got = {(r.doc_id, r.licence, r.part, r.line) for r in licenses.scan(frame(spark, rows)).collect()}
    assert {x for x in got if x[0] != 4} == {
        (1, "MIT", "window", 0), (2, "LicenseRef-all-rights-reserved", "window", 0),
        (3, "CC-BY-NC-4.0", "window", 1), (5, "MIT", "window", 0)}
    assert {x[1:3] for x in got if x[0] == 4} >= {("Apache-2.0", "line")}


def test_spdx_lines_headings_and_named_licences(spark):
    rows = [(1, "SPDX-License-Identifier: MIT"), (2, "  GNU GENERAL PUBLIC LICENSE\n  Version 2"),
            (3, "GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3, 19 November 2007"),
            (4, "It may be used under the terms of the Apache License 2.0 by anyone."),
            (5, "Licensed under the EUPL, Version 1.2 or later"), (6, "# SPDX-License-Identifier: GPL-3.0-or-later\nimport os"),
            (7, "Distributed under the Boost Software License, Version 1.0. (See accompanying file)"),
            (8, "SPDX-License-Identifier: Unheard-of-1.0"), (9, "Used under the terms of the Unheard Of License 7.1"),
            (10, "The general public was licensed to fish under the bridge; version 2 of the story differs.")]
    got = {r.doc_id: r.licence for r in licenses.scan(frame(spark, rows)).collect()}
    assert got == {1: "MIT", 2: "GPL-2.0", 3: "AGPL-3.0", 4: "Apache-2.0", 5: "EUPL-1.2", 6: "GPL-3.0", 7: "BSL-1.0"}
    assert len({name for name, _ in licenses.KNOWN}) >= 40


def test_windows_are_the_best(spark):
    rng = random.Random(7)
    known = licenses.Templates([("A", "a b c d e f"), ("B", "a b x y")])
    for _ in range(300):
        words = [rng.choice("abcdefxyz") if rng.random() < 0.3 else "abcdef"[i % 6] for i in range(rng.randrange(2, 14))]
        best = max(brute_dice(" ".join(words[i:j]), t) for t in ("a b c d e f", "a b x y")
                   for i in range(len(words)) for j in range(i + 2, len(words) + 1)) if len(words) > 1 else 0
        got = known.windows(words)
        assert bool(got) == (best >= 0.8)
        for start, end, name, dice in got:
            assert dice == brute_dice(" ".join(words[start:end]), {"A": "a b c d e f", "B": "a b x y"}[name]) >= 0.8


# --- packing ---------------------------------------------------------------------------

def test_rows_without_an_id_make_no_large_slot(spark):
    docs = spark.range(0, 6000, numPartitions=4).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a b c").alias("text"))
    got = packing.pack(docs, budget=30).select("bucket", "batch", "place")
    assert got.count() == 6000 == got.distinct().count()
    written = docs.withColumn("at", F.monotonically_increasing_id())
    slots = written.groupBy(F.pmod(F.xxhash64("doc_id", "at", F.lit("packing")), F.lit(packing.SLOTS)).alias("slot")).count()
    assert slots.agg(F.max("count")).first()[0] < 30


def padding(bins, cuts):
    return sum(min(c for c in cuts if c >= length) * n - total for length, n, total in bins)


def test_boundaries_are_optimal():
    rng = random.Random(5)
    for _ in range(300):
        lengths = sorted(rng.sample(range(50), rng.randrange(1, 9)))
        bins = []
        for x in lengths:
            n = rng.randrange(1, 6)
            bins.append((x, n, n * x))
        k = rng.randrange(1, 5)
        best = min(padding(bins, {*s, lengths[-1]}) for r in range(min(k, len(lengths)))
                   for s in itertools.combinations(lengths, r))
        cuts = packing.optimal_boundaries(bins, k)
        assert len(cuts) <= max(k, 1) and padding(bins, cuts) == best


def test_packing(spark):
    rng = random.Random(6)
    rows = [(i, "w " * rng.choice([0, 1, 5, 30, 200, 3000])) for i in range(400)]
    rows += [(500, None), (None, "a b"), (None, "a b"), rows[3]]
    got = packing.pack(frame(spark, rows), buckets=4, budget=1000).collect()
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((i, len((t or "").split())) for i, t in rows)
    sizes = Counter((r.bucket, r.batch) for r in got)
    assert len({(r.bucket, r.batch, r.place) for r in got}) == len(got)
    for r in got:
        assert r.n_tokens <= r.bucket_length
        room = max(1, 1000 // max(1, r.bucket_length))
        last = max(b for k, b in sizes if k == r.bucket)
        assert r.place < room and (sizes[r.bucket, r.batch] == room or r.batch == last)
    assert packing.pack(frame(spark, [])).count() == 0
    counted = packing.pack(frame(spark, rows[:50]), tokens="n_chars").collect()
    assert {r.doc_id: r.n_tokens for r in counted} == {i: len(t) for i, t in rows[:50]}


def test_length_bins_are_few_and_ordered(spark):
    got = spark.createDataFrame([(n,) for n in [*range(0, 5000), 10**6, 10**9, 10**12]], "n long").select(
        "n", packing.length_bin(F.col("n")).alias("b")).collect()
    assert all(r.b == r.n for r in got if r.n <= packing.FINE)
    assert all(r.b <= r.n < r.b * (1 + 1 / 256) for r in got if r.n > packing.FINE)
    bins = [r.b for r in sorted(got, key=lambda r: r.n)]
    assert bins == sorted(bins)


# --- token rollups ---------------------------------------------------------------------

def totals(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in rollup.totals().collect()}


def test_rollup_is_idempotent_and_additive(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b, c", "en", "x"), (2, "d e", "en", "x"), (3, None, None, "y"),
                                  (4, "", "en", None)], "doc_id long, text string, lang string, source string")
    rollup = token_rollup.Rollup(spark, str(tmp_path / "rollup"))
    assert totals(rollup) == {}
    assert rollup.commit("1", token_rollup.inserts(docs)) and not rollup.commit("1", token_rollup.inserts(docs))
    first = totals(rollup)
    assert first["x", "en", "words-1"] == (2, 5) and first["x", "en", "pieces-1"] == (2, 6)
    assert first["y", None, "words-1"] == (1, 0) and first[None, "en", "words-1"] == (1, 0)
    rollup.commit("2", token_rollup.deletes(docs.filter("doc_id = 2")))
    rollup.commit("3", token_rollup.revisions(docs.filter("doc_id = 1").withColumn("new", F.lit("a")), "new"))
    rollup.commit("4", token_rollup.inserts(docs.limit(0)))
    want = totals(rollup)
    assert want["x", "en", "words-1"] == (1, 1)
    assert rollup.compact() and totals(rollup) == want
    assert not rollup.commit("2", token_rollup.inserts(docs)) and totals(rollup) == want
    rollup.commit("5", token_rollup.inserts(docs))
    assert rollup.compact() and totals(rollup)["x", "en", "words-1"] == (3, 6)
    assert not rollup.commit("1", token_rollup.inserts(docs))


def test_a_batch_without_its_mark_is_written_anew(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b", "en", "x")], "doc_id long, text string, lang string, source string")
    rollup = token_rollup.Rollup(spark, str(tmp_path / "rollup"))
    rollup.commit("1", token_rollup.inserts(docs))
    (tmp_path / "rollup" / "batch=1" / "_SUCCESS").unlink()
    assert totals(rollup) == {}
    assert rollup.commit("1", token_rollup.inserts(docs)) and totals(rollup)["x", "en", "words-1"] == (1, 2)
    with pytest.raises(ValueError):
        rollup.commit("../x", token_rollup.inserts(docs))


# --- main text -------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="no-sidebar">
<header><h1>Site name</h1></header><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>
<div class="cookie-notice">We use cookies, as all do, and more words follow here to make it long.</div>
<article><header><h1>The &quot;title&quot;</h1></header><p><b>First &amp; foremost<br>sentence of the article, which is long.
<p>Second   paragraph\twith more to say about the matter at hand.</p><form><p>Mail us</p><input></form>
<div class="share">Share this</div><blockquote>A quoted line.</blockquote></article>
<aside><p>Related stories that nobody asked for, told at some length.</p></aside>
<section id="comments"><p>Great post, I agree with every word of it, thank you so much.</p></section>
<script>var x = "<p>no</p>";</script><footer>&copy; 2020</footer></body></html>"""


def test_main_text_of_a_page():
    assert html_mincut.main_text(PAGE) == (
        "The \"title\"\n\nFirst & foremost sentence of the article, which is long.\n\n"
        "Second paragraph with more to say about the matter at hand.\n\nA quoted line.")


def test_main_text_without_an_article_element():
    words = "This sentence has a fair number of words, as running text has. " * 3
    page = ("<div id=menu><a href=x>One</a> <a href=y>Two</a></div>" + "".join(f"<div><p>{words}</div>" for _ in range(4))
            + "<div class='footer'>Imprint</div>")
    assert html_mincut.main_text(page).split("\n\n") == [words.strip()] * 4


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("  plain   text ", "plain text"), ("<p", ""), ("a < b &am", "a < b &am"),
    ("<article><p>Cut off <b", "Cut off"), ("<article><p a=\"x>y</p>", "y"), ("<script>x", ""),
    ("<article>" + "<div>" * 3000 + "deep" + "</article>", "deep"),
    ("<article><p>First.</p><p>" + "<b>" * 520 + "deep" + "</b>" * 520 + "</p><p>Last one.</p></article><p>Out.</p>",
     "First.\n\ndeep\n\nLast one."),
    ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>Last one.</p></article>", "deep\n\nLast one."),
    ("<article><p>" + "long words here. " * 20000 + "</p></article>", ("long words here. " * 20000).strip())])
def test_odd_pages(page, want):
    assert html_mincut.main_text(page) == want


def test_minimum_cut_equals_brute_force():
    rng = random.Random(7)
    for _ in range(200):
        n = rng.randrange(1, 8)
        odds = [rng.choice([-3, -1, 0, 1, 2]) + rng.random() for _ in range(n)]
        edges = [(a, b, rng.random() * 2) for a in range(n) for b in range(a) if rng.random() < 0.5]

        def cost(keep):
            return (sum(max(v, 0) for v, k in zip(odds, keep) if not k) + sum(max(-v, 0) for v, k in zip(odds, keep) if k)
                    + sum(w for a, b, w in edges if keep[a] != keep[b]))

        best = min(map(cost, itertools.product([False, True], repeat=n)))
        assert cost(html_mincut.minimum_cut(odds, edges)) == pytest.approx(best)


def test_extract(spark):
    pages = spark.createDataFrame([(i, f"http://x/{i}", PAGE, "t") for i in range(20)] + [(50, None, None, "t")] * 2,
                                  "page_id long, url string, html string, text string")
    got = html_mincut.extract(pages).collect()
    assert len(got) == 22 and all(r.n_chars == len(r.text) for r in got)
    assert {r.text for r in got if r.page_id < 20} == {html_mincut.main_text(PAGE)}
    assert html_mincut.extract(pages.limit(0)).count() == 0


# --- pipeline --------------------------------------------------------------------------

def test_pipeline(spark, tmp_path):
    rng = random.Random(8)
    new = lambda n: " ".join(f"t{rng.randrange(10**6)}" for _ in range(n))
    passage, item = new(70), new(30)
    rows = [(i, new(90) + ".") for i in range(40)]
    rows += [(40, rows[0][1]), (41, rows[1][1].upper()), (42, rows[2][1] + "\n" + item)]
    rows += [(50, new(60) + "\n" + passage), (51, new(60) + "\n" + passage), (60, None), (None, new(40)), (61, "")]
    rows += [(100 + i, " ".join(w + "!!" for w in new(60).upper().split())) for i in range(40)]
    labels = [(i, int(i < 100), 0) for i, _ in rows if i is not None]
    base = str(tmp_path)
    extra = [(i, t, "en", "s", len(t or ""), "row") for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string"
    spark.createDataFrame(extra, schema).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{base}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, base).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
        kept.append({r.doc_id: r for r in docs.collect()})
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "row"]
    assert not any(i is not None and i >= 100 for i in kept[0]) and set(range(40)) <= set(kept[0])
    assert 40 not in kept[1] and set(range(40)) | {50, 51, None} <= set(kept[1])
    assert kept[2][50].text == dict(rows)[50] and passage not in kept[2][51].text
    assert kept[2][51].n_chars == len(kept[2][51].text)
    assert 42 in kept[1] and (42 not in kept[3] or item not in kept[3][42].text)
    assert set(kept[4]) == set(kept[3])
    assert sorted(map(repr, kept[4].values())) == sorted(repr(r) for r in corpus_pipeline.run(spark, base).collect())
