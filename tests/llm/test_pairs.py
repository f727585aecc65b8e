"""Near duplicates, passages, decontamination and nearest vectors against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lexmill.llm import ann, components, decontaminate, passages, simhash_dedup

DOCS = "doc_id long, text string, key string, hash string, row string, n_chars long"


def frame(spark, rows):
    """Rows (doc_id, text) with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, "k", "h", "r", len(t or "")) for i, t in rows], DOCS)


def invented(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def simple_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.fixture(scope="module")
def near_rows():
    rng = random.Random(5)
    rows = [(0, None), (1, ""), (2, "  \n"), (3, "One"), (4, "ONE"), (5, "one two"), (None, "one two")]
    base = invented(rng, 300)
    for i in range(10, 90):
        words = base.split()
        for _ in range(rng.randrange(6)):
            words[rng.randrange(len(words))] = "x"
        rows.append((i, " ".join(words)))
    rows += [(i, invented(rng, rng.randrange(1, 60))) for i in range(100, 160)]
    rows += [rows[20], (200, rows[20][1]), (201, "É " * 5000), (202, "é " * 5000)]
    return rows


def test_near_duplicates_equal_brute_force(spark, near_rows):
    got = simhash_dedup.near_duplicates(frame(spark, near_rows)).collect()
    values = [simple_fingerprint(t) for _, t in near_rows]
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= 3:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(near_rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    want = sorted(((d, values[i], least.get(root(i))) for i, (d, _) in enumerate(near_rows)), key=repr)
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=repr) == want
    assert len({r.component_id for r in got}) < len(got) - 50


def test_one_document_of_each_group_stays(spark, near_rows):
    docs = frame(spark, near_rows)
    kept = simhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    groups = {r.component_id for r in simhash_dedup.near_duplicates(docs).collect()}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(groups)


def test_rows_of_one_id_with_other_texts_stay(spark):
    texts = ["alpha beta gamma delta epsilon zeta", "one two three four five six seven"]
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[1])]
    assert sorted(r.text for r in simhash_dedup.keep_one(frame(spark, rows)).collect()) == texts


def test_index_finds_every_link_in_a_long_run():
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 2**63, 12, dtype=np.uint64)
    values = np.unique(np.concatenate([c ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64))
                                       ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)) for c in centre]))
    labels = np.arange(len(values))
    simhash_dedup.link_run(values, labels, 0, 3)
    want = np.arange(len(values))
    for i in range(len(values)):
        near = np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 3)
        simhash_dedup.resolve_pairs(want, np.full(len(near), i), near)
    assert np.array_equal(labels, want)


def test_blocks_of_one_key_in_several_tasks_meet():
    values = np.arange(64, dtype=np.uint64)
    labels = np.arange(64)
    simhash_dedup.link_run(values, labels, 0, 1, split=40)
    want = np.arange(64)
    for a in range(40):
        b = np.array([b for b in range(40, 64) if bin(a ^ b).count("1") <= 1], dtype=int)
        simhash_dedup.resolve_pairs(want, np.full(len(b), a), b)
    assert np.array_equal(labels, want)


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(400 + i, 401 + i) for i in range(40)]
    links += [(7, 7), (None, 3), (links[0])]
    parent = list(range(500))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for a, b in links:
        if a is not None:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components.connected_components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    ends = {x for a, b in links if a is not None and a != b for x in (a, b)}
    assert got == {x: root(x) for x in ends}


def test_empty_tables(spark):
    docs = frame(spark, [])
    items = spark.createDataFrame([], "item_id long, text string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert simhash_dedup.near_duplicates(docs).count() == 0
    assert simhash_dedup.keep_one(docs).count() == 0
    assert passages.repeated_passages(docs).count() == 0
    assert passages.without_repeats(docs).count() == 0
    assert decontaminate.contaminated(docs, items).count() == 0
    assert decontaminate.contaminated(docs, spark.createDataFrame([(1, "a b c d e f")], items.schema)).count() == 0
    assert decontaminate.contaminated(frame(spark, [(1, "a b c d e f")]), items).count() == 0
    assert ann.nearest(vectors).count() == 0


@pytest.fixture(scope="module")
def passage_rows():
    rng = random.Random(9)
    shared = [invented(rng, 80, 10**6) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [invented(rng, rng.randrange(5, 120), 10**6)]
        if i % 2:
            parts.insert(rng.randrange(2), shared[i % 4])
        rows.append((i, "\n".join(parts)))
    fuzzy = shared[3].split()
    for at in range(10, 80, 20):
        fuzzy[at] = "changed"
    del fuzzy[45]
    rows += [(70, " ".join(fuzzy)), (71, None), (72, ""), (None, shared[1]), (73, "same " * 200), rows[1]]
    return shared, rows


def test_repeated_passages(spark, passage_rows):
    shared, rows = passage_rows
    got = passages.repeated_passages(frame(spark, rows)).collect()
    texts = dict(rows)
    seen, want = set(), set()
    for i, t in rows[:60]:
        held = [k for k, s in enumerate(shared) if s in t]
        want |= {i for k in held if k in seen}
        seen |= set(held)
    assert {r.doc_id for r in got} == want | {70}
    for r in got:
        here = texts[r.doc_id].split()[r.start:r.end]
        there = texts[r.source_id].split()[r.source_start:r.source_end]
        assert r.source_id < r.doc_id and len(here) >= 50
        assert r.matched >= 0.8 * max(len(here), len(there))
        if r.doc_id != 70:
            assert here == there and len(here) >= 79


def test_passages_made_of_earlier_lines(spark):
    rng = random.Random(21)
    lines = [invented(rng, 30, 10**6) for _ in range(3)]
    more = lambda: invented(rng, 40, 10**6)
    both = " ".join(lines[:2])
    rows = [(i, f"{more()} {x} {more()}") for i, x in enumerate(lines)]
    rows += [(4, f"{more()} {both} {more()}"), (5, f"{more()} {lines[0]} {more()}"), (6, f"{more()} {lines[1]} {more()}"),
             (7, f"{more()} {both}")]
    got = passages.repeated_passages(frame(spark, rows)).collect()
    assert {(r.doc_id, r.source_id, r.start, r.end) for r in got} == {(7, 4, 40, 100)}


@pytest.mark.parametrize("every, share", [(10, 1), (8, 1), (6, 0.9)])
def test_fuzzy_passages_by_edit_rate(spark, every, share):
    rng = random.Random(every)
    rows = []
    for i in range(60):
        words = invented(rng, 80, 10**6).split()
        rows.append((i, " ".join([invented(rng, 30, 10**6), *words, invented(rng, 30, 10**6)])))
        for at in range(rng.randrange(every), 80, every):
            words[at] = f"edit{rng.randrange(10**6)}"
        rows.append((100 + i, " ".join([invented(rng, 45, 10**6), *words, invented(rng, 20, 10**6)])))
    got = {(r.doc_id, r.source_id) for r in passages.repeated_passages(frame(spark, rows)).collect()}
    print("found", every, len(got))
    assert got <= {(100 + i, i) for i in range(60)} and len(got) >= share * 60


def test_cutting_keeps_the_rest(spark, passage_rows):
    shared, rows = passage_rows
    docs = frame(spark, rows)
    out = passages.without_repeats(docs)
    assert out.columns == docs.columns
    got = Counter((r.doc_id, r.text, r.n_chars) for r in out.collect())
    for s in shared:
        assert sum(n for (i, t, _), n in got.items() if t and s in t and i is not None) <= (2 if s in rows[1][1] else 1)
    for i, t in rows:
        if not t or not any(s in t for s in shared) and i != 70:
            assert (i, t, len(t or "")) in got
    assert all(n == len(t or "") for _, t, n in got)


def test_cut_bytes():
    assert passages.cut("a  b\nc é d".encode(), [(1, 3)]).decode() == "a  é d"
    assert passages.cut(b"a b", [(0, 2)]) == b""


def test_chains_are_the_best():
    rng = random.Random(2)
    for _ in range(200):
        m = rng.randrange(1, 7)
        x0 = [rng.randrange(60) for _ in range(m)]
        y0 = [rng.randrange(60) for _ in range(m)]
        size = [rng.randrange(1, 12) for _ in range(m)]
        x1, y1 = [a + s for a, s in zip(x0, size)], [a + s for a, s in zip(y0, size)]

        def value(one):
            total = sum(size[i] for i in one)
            for i, j in zip(one, one[1:]):
                total -= passages.GAP * (x0[j] - x1[i] + y0[j] - y1[i])
            return total

        def every(one):
            yield one
            for j in range(m):
                if x1[one[-1]] <= x0[j] and y1[one[-1]] <= y0[j]:
                    yield from every([*one, j])

        best = max(value(c) for i in range(m) for c in every([i]))
        chains = passages.chain(x0, x1, y0, y1)
        assert sorted(i for c in chains for i in c) == list(range(m))
        assert max(map(value, chains)) == pytest.approx(best)


def brute_contaminated(rows, items):
    out = {}
    for doc, text in rows:
        words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
        for item, passage in items:
            target = [w for w in re.split(r"[\W_]+", (passage or "").lower()) if w]
            if not target:
                continue
            k = min(5, len(target))
            grams = lambda w: Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
            want = grams(target)
            for at in range(max(1, len(words) - len(target) + 1)):
                here = grams(words[at:at + len(target)])
                same = sum((here & want).values())
                value = same / (sum(here.values()) + sum(want.values()) - same)
                if value >= 0.8:
                    out[doc, item] = max(out.get((doc, item), 0), value)
    return out


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(4)
    items = [(i, invented(rng, rng.choice([1, 3, 5, 20, 40]), 10**5)) for i in range(12)] + [(50, None), (51, " ")]
    rows = [(None, items[0][1]), (900, None), (901, ""), (902, "short")]
    for i in range(40):
        parts = [invented(rng, 60, 10**5)]
        if i % 3:
            words = items[i % 12][1].split()
            if i % 4 == 0 and len(words) >= 40:
                words[0] = "changed"
            parts.insert(1, ", ".join(words).upper())
        rows.append((i, " -- ".join(parts)))
    rows += [rows[6], (903, " ".join([items[3][1]] * 3))]
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(
        frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == pytest.approx(brute_contaminated(rows, items)) and len(got) > 25


def test_only_rows_that_hold_an_item_go(spark):
    leak = "alpha beta gamma delta epsilon zeta eta theta"
    rows = [(None, leak), (None, "clean words only here"), (None, None), (7, f"so {leak}"), (7, "clean row of seven"), (8, "eight")]
    docs = frame(spark, rows)
    kept = decontaminate.without_contaminated(docs, spark.createDataFrame([(1, leak)], "item_id long, text string"))
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(rows[1:3] + rows[4:])


def test_lookup_in_blocks_gives_the_same(spark, monkeypatch):
    rng = random.Random(8)
    items = [(i, invented(rng, 30)) for i in range(6)]
    rows = [(i, invented(rng, 20) + " " + items[i % 6][1]) for i in range(12)]
    run = lambda: sorted(map(tuple, decontaminate.contaminated(
        frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()))
    one = run()
    monkeypatch.setattr(decontaminate, "LOOKUP_ROWS", 50)
    assert run() == one and len(one) == 12


def test_decontamination_is_native(spark):
    items = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    plan = decontaminate.contaminated(frame(spark, [(1, "a b c d e f g")]), items)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def nearest_by_hand(rows, k, number=np.float32):
    """One list for each row of an id divisible by 20; lists of one id in any order."""
    good = {(i, tuple(float(number(x)) for x in v)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for q, w in good:
        if q % 20 == 0:
            scores = []
            for i, v in good - {(q, w)}:
                if len(v) == len(w):
                    total = 0.0
                    for a, b in zip(v, w):
                        total += a * b
                    scores.append((-total, i))
            out.append([(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)])
    return sorted(x for x in out if x)


def nearest_lists(df):
    lists = {}
    for r in df.collect():
        lists.setdefault((r.query_id, r.query_key), []).append(tuple(r)[:4])
    return sorted(sorted(x) for x in lists.values())


def test_nearest_vectors_with_ties_and_bad_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=6).round(2).tolist()) for i in range(150)]
    rows += [(i, [1.0, 0.0, 0.0, 0.0, 0.0, 2.0]) for i in range(200, 260)]
    rows += [(300, None), (320, []), (340, [0.0] * 6), (360, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
             (380, [float("nan")] * 6), (400, [float("inf")] * 6), (None, [1.0] * 6), (420, [1.0, 2.0]),
             (440, [3.0, 1.0]), rows[20]]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows],
                                  "vec_id long, embedding array<float>, node string, shard int")
    assert nearest_lists(ann.nearest(table, shards=3)) == nearest_by_hand(rows, 20)


def test_nearest_vectors_of_ids_with_several_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), rng.normal(size=5).round(1).tolist()) for i in rng.integers(0, 45, 240)]
    rows += [(20, rng.normal(size=5).round(1).tolist()) for _ in range(40)]       # a hot id
    rows += [(5, rows[0][1]), (40, rows[0][1]), (5, rows[0][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for size in (32_000_000, 1_000):                                             # 1,000: many small shards
        assert nearest_lists(ann.nearest(table, shards=2, shard_values=size)) == nearest_by_hand(rows, 20, float)


@pytest.mark.parametrize("unit, least", [(True, 0.95), (False, 0.9)])
def test_recall_of_one_shard(unit, least):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 32)).astype(np.float32)
    if unit:
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    q = rng.normal(size=(100, 32)).astype(np.float32)
    levelled = ann._level(x)
    flat = np.concatenate((q, np.zeros((100, 1), np.float32)), 1)
    near = ann.search(levelled, ann.build(levelled), flat, ann.SEARCH_WIDTH)
    want = np.argsort(-(q @ x.T), axis=1)[:, :20]
    assert np.mean([len(set(a[:20]) & set(b)) / 20 for a, b in zip(near, want)]) > least


def test_hot_vector_is_one_node(spark):
    table = spark.range(3000).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"))
    nodes = ann.fold(ann.usable(table), 21).collect()
    assert len(nodes) == 1 and nodes[0].members == list(range(21))
