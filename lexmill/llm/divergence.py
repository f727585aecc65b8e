"""Term divergence between the sources of a language, through a transducer.

1. A term is a run of letters, A-Z lower-cased; every character from U+0080 on
   is a letter.  Each task counts in how many documents a term stands; the sums
   leave the terms that at least MIN_DOCS documents of a language have.
2. The kept terms are ranged by (language, term) and each range builds minimal
   acyclic transducers from its sorted terms, SHARD_TERMS terms at most in one:
   suffixes that accept the same rest are one state, and every edge carries how
   many terms sort before those behind it, so that the sum along a term's path is
   its lexicographic ordinal, and an ordinal leads back to its term.
3. The texts are streamed through the transducers, which count the kept terms of
   every (language, source) by ordinal.  Transducers reach the tasks in rounds of
   ROUND_BYTES at most; more vocabulary takes more rounds over the texts.  A task
   hands on its counts as one row a block of ordinals, not one a term, and the rows
   of a block are summed where they meet.
4. Blocks of ordinals hold the counts of all sources of a language.  Each block
   gives partial sums of the divergence of every two sources, and per source its
   best terms; equal values are ordered by ordinal.

With count n of a term, N of all kept terms and V kept terms, the share of a term
is p = 1 + floor(10^9 (n + 2) / (N + 2 V)), and two shares p, q are
floor((p - q)^2 / (p + q)) apart; all in whole numbers.

Cases: null text, language and source are ''; texts without a term count for no
term, but their (language, source) takes part; a language without kept terms has
pairs of value 0; a source alone in its language has no pairs; repeated rows
count as often as they stand; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lexmill.llm.shared import binary_texts, materialize

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
SHARD_TERMS = 65_536          # terms of one transducer
ROUND_BYTES = 64 << 20        # transducers that a task holds at once
BLOCK_TERMS = 512             # ordinals of a block, fewer where many sources share one
BLOCK_CELLS = 1 << 22
_HELD = 800_000               # distinct terms that a task holds before it hands them on

# ASCII that is no letter ends a term; bytes from 0x80 on are parts of letters.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


class Transducer:
    """Minimal acyclic transducer of sorted distinct terms: term <-> ordinal.

    The edges of state s are labels[first[s]:first[s + 1]], in byte order, and
    lead to `target`; `before` counts the terms accepted ahead of those that
    take the edge.
    """

    def __init__(self, labels: bytes, first: list, target: list, before: list, final: bytes, root: int):
        self.labels, self.first, self.target, self.before = labels, first, target, before
        self.final, self.root = final, root

    @classmethod
    def build(cls, ordered: list[bytes]) -> Transducer:
        known: dict[tuple, int] = {}
        finals, edges = bytearray(), []

        def settle(state: list) -> int:
            """Number of the state; equal ones are one."""
            sign = (state[0], tuple(state[1]))
            if sign not in known:
                known[sign] = len(edges)
                finals.append(state[0])
                edges.append(sign[1])
            return known[sign]

        path: list[list] = [[0, []]]         # states of the last term: [final, edges settled]
        last = b""
        for term in ordered:
            shared = 0
            for x, y in zip(term, last):
                if x != y:
                    break
                shared += 1
            while len(path) > shared + 1:
                done = settle(path.pop())
                path[-1][1].append((last[len(path) - 1], done))
            path.extend([0, []] for _ in term[shared:])
            path[-1][0] = 1
            last = term
        while len(path) > 1:
            done = settle(path.pop())
            path[-1][1].append((last[len(path) - 1], done))
        root = settle(path[0])
        below: list[int] = []                # terms accepted from each state; targets settle first
        first, target, before, labels = [0], [], [], bytearray()
        for final, out in zip(finals, edges):
            total = final
            for label, to in out:
                labels.append(label)
                target.append(to)
                before.append(total)
                total += below[to]
            below.append(total)
            first.append(len(target))
        return cls(bytes(labels), first, target, before, bytes(finals), root)

    def ordinal(self, term: bytes) -> int:
        """Place of the term among all terms, -1 where it is none."""
        state, found = self.root, 0
        labels, first, target, before = self.labels, self.first, self.target, self.before
        for label in term:
            edge = labels.find(label, first[state], first[state + 1])
            if edge < 0:
                return -1
            found += before[edge]
            state = target[edge]
        return found if self.final[state] else -1

    def term(self, ordinal: int) -> bytes:
        state, out = self.root, bytearray()
        while ordinal or not self.final[state]:
            edge = bisect_right(self.before, ordinal, self.first[state], self.first[state + 1]) - 1
            out.append(self.labels[edge])
            ordinal -= self.before[edge]
            state = self.target[edge]
        return bytes(out)

    def dump(self) -> bytes:
        head = np.array([self.root, len(self.final), len(self.labels)], dtype=np.int32)
        parts = [np.array(x, dtype=np.int32).tobytes() for x in (self.first, self.target, self.before)]
        return b"".join([head.tobytes(), *parts, self.labels, self.final])

    @classmethod
    def load(cls, blob: bytes) -> Transducer:
        root, states, edges = np.frombuffer(blob, dtype=np.int32, count=3).tolist()
        numbers = np.frombuffer(blob, dtype=np.int32, offset=12, count=states + 1 + 2 * edges).tolist()
        at = 12 + 4 * len(numbers)
        return cls(blob[at:at + edges], numbers[:states + 1], numbers[states + 1:states + 1 + edges],
                   numbers[states + 1 + edges:], blob[at + edges:], root)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                         for c in ("lang", "source", "text")])


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, docs) of (lang, text), partial sums."""
    held: dict[str, Counter] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, found in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(lang, len(found)), pa.array(list(found), pa.binary()).cast(pa.string()),
                 pa.array(np.fromiter(found.values(), dtype=np.int64, count=len(found)))],
                names=["lang", "term", "docs"])
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), binary_texts(batch.column(1))):
            held.setdefault(lang, Counter()).update(set(terms(text)))
            if sum(map(len, held.values())) > _HELD:
                yield from out()
    yield from out()


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, first, terms, blob): transducers of sorted (lang, term)."""
    def one(lang: str, part: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([lang], pa.string()), pa.array([part[0]], pa.binary()),
             pa.array([len(part)], pa.int64()), pa.array([Transducer.build(part).dump()], pa.binary())],
            names=["lang", "first", "terms", "blob"])

    held: list[bytes] = []
    of = None
    for batch in batches:
        for lang, term in zip(batch.column(0).to_pylist(), binary_texts(batch.column(1))):
            if held and (lang != of or len(held) == SHARD_TERMS):
                yield one(of, held)
                held = []
            of = lang
            held.append(term)
    if held:
        yield one(of, held)


def vocabulary(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, first, terms, blob): the transducers of the kept terms of every
    language, each of a range of terms that starts with `first`."""
    found = _texts(docs).select("lang", "text").mapInArrow(_document_counts, "lang string, term string, docs long")
    kept = found.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs)
    ranged = kept.select("lang", "term").repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    return materialize(ranged.mapInArrow(_shards, "lang string, first binary, terms long, blob binary"),
                       "transducers")


class _Round:
    """Transducers that a task holds at once, by language: those of its terms."""

    def __init__(self, rows: list[tuple]):
        self.of: dict[str, tuple[list, list, list]] = {}
        self.seen: dict[str, dict[bytes, int]] = {}
        for lang, first, base, blob in sorted(rows):
            starts, bases, loaded = self.of.setdefault(lang, ([], [], []))
            starts.append(first)
            bases.append(base)
            loaded.append(Transducer.load(blob))

    def ordinals(self, lang: str, counted: Counter) -> tuple[np.ndarray, np.ndarray]:
        """Ordinals and counts of those terms that this round knows.  A term that
        several sources have is walked once and remembered."""
        starts, bases, loaded = self.of.get(lang, ([], [], []))
        if not starts:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        seen = self.seen.setdefault(lang, {})
        if len(seen) > _HELD:
            seen.clear()
        for term in counted.keys() - seen.keys():
            at = bisect_right(starts, term) - 1
            place = loaded[at].ordinal(term) if at >= 0 else -1
            seen[term] = bases[at] + place if place >= 0 else -1
        places = np.fromiter(map(seen.__getitem__, counted), dtype=np.int64, count=len(counted))
        counts = np.fromiter(counted.values(), dtype=np.int64, count=len(counted))
        return places[places >= 0], counts[places >= 0]

    def term(self, lang: str, ordinal: int) -> bytes:
        _, bases, loaded = self.of[lang]
        at = bisect_right(bases, ordinal) - 1
        return loaded[at].term(ordinal - bases[at])


def _rounds(shards: DataFrame, round_bytes: int) -> Iterator[tuple]:
    """(broadcast rows of one round, the languages and ordinals that it covers).
    The driver sees one line per transducer and the transducers of one round."""
    spark = shards.sparkSession
    index = shards.select("lang", "first", "terms", F.length("blob").alias("size")).collect()
    lines, base = [], Counter()
    total = 0
    for lang, first, n, size in sorted(index, key=lambda r: (r.lang, r.first)):
        lines.append((total // round_bytes, lang, bytes(first), base[lang], n))
        base[lang] += n
        total += size
    for turn in sorted({line[0] for line in lines}):
        mine = [line[1:] for line in lines if line[0] == turn]
        low, high = mine[0][:2], mine[-1][:2]
        place = F.struct("lang", "first")
        rows = shards.filter(place.between(F.struct(F.lit(low[0]), F.lit(low[1])),
                                           F.struct(F.lit(high[0]), F.lit(high[1]))))
        blobs = {(r.lang, bytes(r.first)): bytes(r.blob) for r in rows.select("lang", "first", "blob").collect()}
        yield (spark.sparkContext.broadcast([(lang, first, at, blobs[lang, first]) for lang, first, at, _ in mine]),
               [(lang, at, at + n) for lang, _, at, n in mine])


#: How often a source has the terms of a block of `width` ordinals: their places in it
#: (32-bit), ascending, their counts (64-bit), and the sum of these.
_COUNTS = "lang string, block long, width long, source string, places binary, counts binary, total long"


def _packed(lang: str, source: str, ordinals: np.ndarray, counts: np.ndarray, width: int) -> pa.RecordBatch:
    """_COUNTS of ascending ordinals."""
    blocks, places = np.divmod(ordinals, width)
    starts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]])
    ends = np.r_[starts, len(blocks)]

    def binary(values: np.ndarray) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), len(starts), [
            None, pa.py_buffer((ends * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])

    return pa.RecordBatch.from_arrays(
        [pa.repeat(lang, len(starts)), pa.array(blocks[starts]), pa.repeat(pa.scalar(width, pa.int64()), len(starts)),
         pa.repeat(source, len(starts)), binary(places.astype(np.int32)), binary(counts),
         pa.array(np.add.reduceat(counts, starts))],
        names=["lang", "block", "width", "source", "places", "counts", "total"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """_COUNTS sorted by language and block, one row for each source of a block."""
    held: dict[str, np.ndarray] = {}
    of = None

    def out() -> Iterator[pa.RecordBatch]:
        lang, block, width = of
        for source, n in held.items():
            places = np.flatnonzero(n)
            yield _packed(lang, source, places + block * width, n[places], width)

    for batch in batches:
        for lang, block, width, source, places, counts in zip(*(c.to_pylist() for c in batch.columns[:6])):
            if (lang, block, width) != of:
                if held:
                    yield from out()
                of, held = (lang, block, width), {}
            if source not in held:
                held[source] = np.zeros(width, dtype=np.int64)
            held[source][np.frombuffer(places, dtype=np.int32)] += np.frombuffer(counts, dtype=np.int64)
    if held:
        yield from out()


def _recount(held_round, widths: dict[str, int]):
    """_COUNTS of (lang, source, text), partial sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Round(held_round.value)
        held: dict[tuple, Counter] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), counted in held.items():
                places, counts = known.ordinals(lang, counted)
                order = np.argsort(places)
                if len(order):
                    yield _packed(lang, source, places[order], counts[order], widths[lang])
            held.clear()

        size = 0
        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                          binary_texts(batch.column(2))):
                counted = held.setdefault((lang, source), Counter())
                size -= len(counted)
                counted.update(terms(text))
                size += len(counted)
                if size > _HELD:
                    yield from out()
                    size = 0
        yield from out()
    return run


def counts_by_source(docs: DataFrame, shards: DataFrame, widths: DataFrame,
                     round_bytes: int = ROUND_BYTES) -> DataFrame:
    """_COUNTS: how often a source has each kept term.  `widths` are the widths of the
    blocks by language; a task holds one block of counts at a time when it sums."""
    texts, parts = _texts(docs), []
    wide = {r.lang: r.width for r in widths.join(shards.select("lang").distinct(), "lang").collect()}
    for rows, covered in _rounds(shards, round_bytes):
        parts.append(texts.mapInArrow(_recount(rows, {lang: wide[lang] for lang, *_ in covered}), _COUNTS))
    if not parts:
        return docs.sparkSession.createDataFrame([], _COUNTS)
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    met = found.repartition("lang", "block").sortWithinPartitions("lang", "block")
    return materialize(met.mapInArrow(_summed, _COUNTS), "term_counts")


def _share(n: np.ndarray, total: int | np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (n + 2) / total) in whole numbers, beyond 64 bits too."""
    if n.size and int(n.max()) + 2 > (1 << 63) // SCALE - 1:
        n = n.astype(object)
    return (1 + SCALE * (n + 2) // total).astype(np.int64)


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


_FOUND = pa.schema([("lang", pa.string()), ("source", pa.string()), ("other", pa.string()),
                    ("ordinal", pa.int64()), ("value", pa.int64())])


def _block(key, table):
    """Divergences of one block of ordinals of one language: a row of every two
    sources and the TOP rows (source, ordinal) of each source.  Rows whose
    `places` is null list the sources with their totals."""
    rows = table.to_pydict()
    listed = [i for i, at in enumerate(rows["places"]) if at is None]
    listed.sort(key=lambda i: rows["source"][i].encode())
    names = [rows["source"][i] for i in listed]
    at = {name: i for i, name in enumerate(names)}
    one = listed[0]
    lang, start, width, vocabulary_size = (rows[c][one] for c in ("lang", "start", "width", "v"))
    totals = np.array([rows["total"][i] for i in listed], dtype=np.int64)
    size = max(0, min(width, vocabulary_size - start))
    n = np.zeros((len(names), size), dtype=np.int64)
    for source, places, counts in zip(rows["source"], rows["places"], rows["counts"]):
        if places is not None:
            n[at[source], np.frombuffer(places, dtype=np.int32)] = np.frombuffer(counts, dtype=np.int64)
    out = []

    def add(source, other, ordinal, value):
        out.append(pa.table([pa.array([lang] * len(value), pa.string()), pa.array([source] * len(value), pa.string()),
                             pa.array(other, pa.string()), pa.array(ordinal, pa.int64()),
                             pa.array(value, pa.int64())], schema=_FOUND))

    if size:
        p = np.stack([_share(n[i], int(totals[i]) + 2 * vocabulary_size) for i in range(len(names))])
        q = _share(n.sum(axis=0), int(rows["all"][one]) + 2 * vocabulary_size)
    else:
        p, q = np.ones((len(names), 0), dtype=np.int64), np.ones(0, dtype=np.int64)
    for i, name in enumerate(names):
        rest = names[i + 1:]
        if rest:
            add(name, rest, [None] * len(rest), _apart(p[i], p[i + 1:]).sum(axis=1))
        places = np.flatnonzero((n[i] > 0) & (p[i] > q))
        value = _apart(p[i, places], q[places])
        best = np.lexsort((places, -value))[:TOP]
        if len(best):
            add(name, [None] * len(best), places[best] + start, value[best])
    return pa.concat_tables(out) if out else _FOUND.empty_table()


def _named(held_round):
    """Terms of (lang, source, ordinal, value, rank), from their ordinals."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Round(held_round.value)
        for batch in batches:
            names = [known.term(lang, ordinal) for lang, ordinal in
                     zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.binary()).cast(pa.string()),
                 batch.column(3), batch.column(4)], names=["lang", "source", "item", "value", "rank"])
    return run


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, round_bytes: int = ROUND_BYTES,
          block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank).  Part `pair`: how far each other
    source of the language is apart, the farthest first.  Part `term`: the TOP
    terms that a source has more of than its language, with their part of the
    divergence from it."""
    shards = vocabulary(docs, min_docs)
    sources = _texts(docs).select("lang", "source").distinct()
    by_lang = Window.partitionBy("lang")
    sources = materialize(sources.withColumn("width", F.greatest(F.lit(1), F.least(
        F.lit(block_terms), F.floor(F.lit(BLOCK_CELLS) / F.count(F.lit(1)).over(by_lang))))), "sources")
    widths = sources.select("lang", "width").distinct()
    counts = counts_by_source(docs, shards, widths, round_bytes)
    totals = counts.groupBy("lang", "source").agg(F.sum("total").alias("total"))
    sizes = shards.groupBy("lang").agg(F.sum("terms").alias("v"))
    groups = (sources.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
              .fillna(0, ["total", "v"]).withColumn("all", F.sum("total").over(by_lang)))
    groups = materialize(groups, "source_totals")
    last = F.greatest(F.lit(0), F.ceil(F.col("v") / F.col("width")) - 1).cast("long")
    none, no_cells = F.lit(None).cast("long"), F.lit(None).cast("binary")
    heads = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last))).select(
        "lang", "block", "source", no_cells.alias("places"), no_cells.alias("counts"), "total", "all", "v",
        (F.col("block") * F.col("width")).alias("start"), "width")
    cells = counts.select("lang", "block", "source", "places", "counts", none.alias("total"), none.alias("all"),
                          none.alias("v"), none.alias("start"), none.alias("width"))
    found = materialize(heads.union(cells).groupBy("lang", "block").applyInArrow(
        _block, "lang string, source string, other string, ordinal long, value long"), "divergence")
    order = Window.partitionBy("lang", "source")
    sums = found.filter(F.col("other").isNotNull()).groupBy("lang", "source", "other").agg(
        F.sum("value").alias("value"))
    pairs = sums.select("lang", "source", F.col("other").alias("item"), "value").union(
        sums.select("lang", F.col("other").alias("source"), F.col("source").alias("item"), "value"))
    pairs = pairs.withColumn("rank", F.row_number().over(order.orderBy(F.desc("value"), "item")))
    best = found.filter(F.col("ordinal").isNotNull()).select("lang", "source", "ordinal", "value").withColumn(
        "rank", F.row_number().over(order.orderBy(F.desc("value"), "ordinal"))).filter(F.col("rank") <= TOP)
    out = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    for rows, covered in _rounds(shards, round_bytes):
        inside = [(F.col("lang") == lang) & F.col("ordinal").between(low, high - 1)
                  for lang, low, high in _spans(covered)]
        mine = best.filter(_any(inside)).mapInArrow(
            _named(rows), "lang string, source string, item string, value long, rank int")
        out = out.union(mine.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
    return out


def _spans(covered: list[tuple]) -> list[tuple]:
    """One span of ordinals per language: the ranges of a round are neighbours."""
    spans: dict[str, tuple] = {}
    for lang, low, high in covered:
        first, last = spans.get(lang, (low, high))
        spans[lang] = (min(first, low), max(last, high))
    return [(lang, *span) for lang, span in spans.items()]


def _any(conditions: list) -> Column:
    found = F.lit(False)
    for one in conditions:
        found = found | one
    return found
