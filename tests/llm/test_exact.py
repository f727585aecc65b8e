"""Exact duplicates, tokenizer alignment and source divergence against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from lexmill.llm import chunk_dedup, divergence, token_alignment

DOCS = ("doc_id long, text string, lang string, source string, row long, chunks string, recipe string, doc string, "
        "key string, n long")


def frame(spark, rows):
    """Rows (doc_id, text[, lang, source]) with extra columns whose names clash
    with inner ones."""
    full = [(*r, None, None)[:4] for r in rows]
    return spark.createDataFrame([(*r, 7, "c", "r", "d", "k", 1) for r in full], DOCS)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --- exact duplicates ---

@pytest.fixture(scope="module")
def copies():
    rng = random.Random(3)
    words = ["Été", "straße", "ΑΣ", "one", "Two", "çà", "\n", "日本"]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    rows = [(0, None), (1, ""), (None, "A"), (2, "a"), (3, "É"), (4, "é"), (5, long), (6, long.swapcase()),
            (7, long[:-1] + "!"), (8, long), (9, "x" + long), (2, "a"), (2, "b")]
    rows += [(20 + i, f"Hot text {'x' * (i % 3)}") for i in range(90)]
    return rows


@pytest.mark.parametrize("bits", [64, 2])
def test_copies_equal_brute_force(spark, copies, bits):
    """With two bits of digest nearly all chunks clash; the result is the same."""
    got = chunk_dedup.exact_groups(frame(spark, copies), bits).collect()
    groups = defaultdict(list)
    for doc_id, text in copies:
        groups[lower(text)].append(-1 if doc_id is None else doc_id)
    want = Counter()
    for text, ids in groups.items():
        sha = hashlib.sha256(text.encode()).hexdigest()
        want.update((i, max(ids), len(ids), sha) for i in ids)
    assert Counter((-1 if r.doc_id is None else r.doc_id, r.keep_id, r.group_size, r.text_sha256)
                   for r in got) == want
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(
        hashlib.sha256(t.encode()).hexdigest() for t in groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_one_of_equal_texts_stays(spark, copies):
    docs = frame(spark, copies)
    kept = chunk_dedup.without_copies(docs)
    assert kept.schema == docs.schema
    assert Counter(lower(r.text) for r in kept.collect()) == Counter({lower(t): 1 for _, t in copies})
    assert chunk_dedup.without_copies(docs.limit(0)).count() == 0
    assert chunk_dedup.exact_groups(docs.limit(0)).count() == 0


def test_chunks_rebuild_the_text_and_survive_edits(spark, copies):
    rows = {r.doc_id: r for r in chunk_dedup.recipes(frame(spark, copies)).filter("doc_id > 4").collect()}
    text = lower(dict(copies)[5])
    assert "".join(rows[5].chunks).encode("latin-1").decode() == text
    sizes = [len(c) for c in rows[5].chunks]
    assert max(sizes) <= chunk_dedup.MAX_CHUNK and min(sizes[:-1]) >= chunk_dedup.MIN_CHUNK
    assert rows[7].recipe[:-1] == rows[5].recipe[:-1]
    rng = random.Random(6)
    text = "".join(rng.choice("etaoin shrdlu cmfwyp") for _ in range(200_000))
    one, two = (set(r.recipe) for r in chunk_dedup.recipes(frame(spark, [(0, text), (1, "x" + text)])).collect())
    assert len(one & two) > 0.9 * len(one)


def test_copies_are_found_without_python(spark, copies):
    plan = chunk_dedup.exact_groups(frame(spark, copies))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- alignment of tokenizers ---

def groups_of(pair, own, text):
    if not text:
        return []
    whole = (" " + text).encode()
    a = own.encode(" " + text, add_special_tokens=False).ids
    b = pair.b.encode(text)
    if b"".join(pair.bytes_a[i] for i in a) != whole or b"".join(pair.bytes_b[i] for i in b) != whole:
        return []
    ends = [np.cumsum([len(of[i]) for i in ids]).tolist() for ids, of in ((a, pair.bytes_a), (b, pair.bytes_b))]
    groups, i, j = [], 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        p, q = ends[0].index(cut, i) + 1, ends[1].index(cut, j) + 1
        groups.append((a[i:p], b[j:q]))
        i, j = p, q
    return groups


def aligned_by_hand(rows):
    pair = token_alignment.Pair()
    own = Tokenizer.from_file(token_alignment.TOKENIZER_A)
    own.encode_special_tokens = True
    found = [(doc_id, groups_of(pair, own, text)) for doc_id, text in rows]
    counts = Counter()
    for _, groups in found:
        counts.update({(a, b) for x, y in groups for a in x for b in y})
    best = Counter()
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for doc_id, groups in found:
        links = [(a, b) for x, y in groups for a in x for b in y]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
                    sum(counts[k] == best[k[0]] for k in links), sum(counts[k] for k in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return Counter(out)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    words = ["straight", "unbelievably", "Été", "naïveté", "日本語", "🙂", "don't", "x1y22", "foo\nbar", "a  b", "\t",
             "https://a.b/c?d=e", "...", " ", "é", "supercalifragilistic"]
    rows = [(0, None), (1, ""), (2, " "), (3, "  two"), (4, "a▁b"), (5, "<|endoftext|> <s> </s> <0x41>"), (6, "\x00 a"),
            (7, "a" * 5000), (8, "\n\n x"), (None, "one two"), (9, "one two"), (9, "one two"), (10, "end ")]
    rows += [(20 + i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 80)))) for i in range(40)]
    rows += [(90, " ".join(rng.choice(words) for _ in range(3000))), (91, "word " * 900 + "▁"), (92, "é" * 3000)]
    return rows


@pytest.mark.parametrize("size, head", [(1 << 16, 1 << 18), (97, 20), (700, 1)])
def test_alignment_equals_brute_force(spark, texts, size, head):
    got = token_alignment.aligned(frame(spark, texts), chunk_bytes=size, head_pairs=head).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert Counter(map(tuple, got.collect())) == aligned_by_hand(texts)


def test_alignment_of_an_empty_table(spark, texts):
    assert token_alignment.aligned(frame(spark, texts).limit(0)).count() == 0


def test_fragments_are_a_monoid():
    """Any bracketing of any cutting gives the groups of the whole."""
    rng = random.Random(1)

    def same(x, y):
        return x.dump() == y.dump() and [t for part in x.closed for t in token_alignment.Groups(part).text] == [
            t for part in y.closed for t in token_alignment.Groups(part).text]

    for _ in range(200):
        total = rng.randrange(1, 60)
        sides = []
        for _ in range(2):
            ends = sorted(rng.sample(range(1, total), rng.randrange(total))) + [total] if total > 1 else [1]
            sides.append((np.arange(len(ends)), np.array(ends)))
        bounds = sorted(rng.sample(range(total), min(total, 4)))
        parts = []
        for low, high in zip([0, *bounds], [*bounds, total]):
            mine = []
            for ids, ends in sides:
                starts = np.concatenate(([0], ends[:-1]))
                at = (starts >= low) & (starts < high)
                mine.append((ids[at], ends[at]))
            parts.append(token_alignment.Fragment.of(tuple(mine)))
        whole = token_alignment.Fragment.of(tuple(sides))
        left = parts[0]
        for p in parts[1:]:
            left = left.then(p)
        right = parts[-1]
        for p in parts[-2::-1]:
            right = p.then(right)
        assert same(left, whole) and same(right, whole)


def test_ranges_cover_a_text_once():
    text = "ab " * 50 + "c" * 400 + " d" * 100
    ranges = token_alignment.byte_ranges(text, 64)
    assert ranges[0][0] == 0 and ranges[-1][1] == len(text) + 1
    assert all(x[1] == y[0] for x, y in zip(ranges, ranges[1:]))
    assert sum("c" in region for *_, region in ranges) == 1


# --- divergence of sources ---

def diverged_by_hand(rows, least):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    groups = {(lang or "", source or "") for _, _, lang, source in rows}
    for _, text, lang, source in rows:
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))
        docs[lang or ""].update(set(found))
        counts[lang or "", source or ""].update(found)
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted((t for t, n in docs[lang].items() if n >= least), key=str.encode)
        sources = [s for x, s in groups if x == lang]
        share = {}
        for name, found in [(s, counts[lang, s]) for s in sources] + [
                (None, sum((counts[lang, s] for s in sources), Counter()))]:
            total = sum(found[t] for t in kept)
            share[name] = [1 + 10**9 * (found[t] + 2) // (total + 2 * len(kept)) for t in kept]
        apart = lambda p, q: (p - q) ** 2 // (p + q)
        for s in sources:
            pairs = [(sum(map(apart, share[s], share[o])), o) for o in sources if o != s]
            best = [(apart(p, q), t) for t, p, q in zip(kept, share[s], share[None]) if counts[lang, s][t] and p > q]
            for part, found in (("pair", pairs), ("term", best)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(found, 1)
                        if part == "pair" or rank <= 10}
    return out


@pytest.mark.parametrize("round_bytes, shard, block", [(1 << 26, 65_536, 512), (200, 7, 5)])
def test_divergence_equals_brute_force(spark, monkeypatch, round_bytes, shard, block):
    rng = random.Random(2)
    words = [f"{c}{v}{c}" for c in "bcdfgéßж日" for v in "aeiou"]
    rows = [(i, " ".join(rng.choice(words[:rng.randrange(2, len(words))]) for _ in range(rng.randrange(40))),
             rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", "é", None])) for i in range(200)]
    rows += [(300, None, "xx", "only"), (301, "rare", "yy", "s1"), (302, "", "yy", "s2"), (303, "...", "en", "empty"),
             rows[0], (None, "Mixed\x00Case BAB bab", "en", "s1")]
    monkeypatch.setattr(divergence, "SHARD_TERMS", shard)
    got = divergence.audit(frame(spark, rows), 5, round_bytes, block).collect()
    assert len(got) == len(set(got))
    assert set(map(tuple, got)) == diverged_by_hand(rows, 5)


def test_divergence_of_an_empty_table(spark):
    assert divergence.audit(frame(spark, []).limit(0)).count() == 0


def test_transducers_are_minimal_and_lead_both_ways():
    rng = random.Random(4)
    for _ in range(50):
        ordered = sorted({bytes(rng.choice(b"abc\xc3") for _ in range(rng.randrange(1, 6))) for _ in range(60)})
        one = divergence.Transducer.load(divergence.Transducer.build(ordered).dump())
        assert [one.ordinal(t) for t in ordered] == list(range(len(ordered)))
        assert [one.term(i) for i in range(len(ordered))] == ordered
        assert one.ordinal(b"d") == one.ordinal(b"") == -1
        rests = {frozenset(t[i:] for t in ordered if t[:i] == p)
                 for w in ordered for i in range(len(w) + 1) for p in [w[:i]]}
        assert len(one.final) == len(rests)          # one state for each set of rests


def test_shares_beyond_64_bits():
    n, total = np.array([0, 10**12]), 10**13
    assert divergence._share(n, total).tolist() == [1 + 10**9 * (x + 2) // total for x in n.tolist()]


def test_counts_travel_as_one_row_a_block(spark):
    """op13_source_divergence: tasks hand on rows of a source and a block, and a block's rows are summed."""
    words = [f"{a}{b}" for a in "bcdfg" for b in "aeiou"]
    rows = [(i, " ".join(words), "en", f"s{i % 2}") for i in range(40)]
    docs = frame(spark, rows).repartition(4)
    widths = spark.createDataFrame([("en", 10), ("fr", 10)], "lang string, width long")
    got = divergence.counts_by_source(docs, divergence.vocabulary(docs, 1), widths).collect()
    assert len(got) == 3 * 2                          # 25 terms, 2 sources; 50 rows of one term before
    assert {(r.block, r.source, r.total) for r in got} == {(b, s, n * 20) for b, n in enumerate((10, 10, 5)) for s in ("s0", "s1")}
    cells = [(r.block * r.width + at, r.source, n) for r in got
             for at, n in zip(np.frombuffer(r.places, np.int32), np.frombuffer(r.counts, np.int64))]
    assert sorted(cells) == [(i, s, 20) for i in range(25) for s in ("s0", "s1")]
