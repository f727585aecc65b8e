"""Fuzzy repeated passages by collinear chaining.

1. Seeds are hashes of runs of words: every run of five words, so five unchanged
   words in a row are a seed; of the runs of WIDE words the smallest of every
   19 in a row, so 50 unchanged words in a row hold one; and, from every fourth
   five-word run, the pair with the run SPREAD words on, which spans a line's end
   and bears changes between.  Seeds that a task sees more than once are linked
   there, so a seed leaves a task once for every _FLUSH seeds, however many
   documents have it.  They go through a shuffle, packed into columns of bytes
   for buckets of the hash; the number of buckets follows the bytes of the texts,
   about _BUCKET seeds each, so that a task holds no more at any size.
2. A seed is linked to its first occurrence, the smallest (doc_id, position), and
   to the document before that has it: first in its task, and the first of each
   task then in the corpus.  A passage that a third of all documents share gives
   at most four links per seed, never all pairs.
3. Links of one (document, source) pair that follow each other on a diagonal
   join to anchors.  Anchors are chained in order of position: a chain gains the
   words of each anchor and pays GAP for every word skipped on either side; a
   Fenwick tree over the positions in the source holds the best chain end so
   far, so a pair with m anchors takes m log m steps.
4. Chains are aligned on the words of both texts: anchors grow word by word,
   gaps are filled by a longest common subsequence.  A chain that matches too
   little is cut at its worst gap and the parts are tried again.

A passage is a span of at least MIN_WORDS words of which at least IDENTITY agree.
A stretch that a longer passage of its document holds is not reported again with
another source.  Rows of one doc_id with different texts share their places: a
long passage of one can hide a shorter one at the same place in the other.

Words are maximal runs without ASCII white space, A-Z lower-cased.  Cases: null
and empty texts, and texts shorter than a passage, have none; rows are told by
doc_id, and repeated rows fold; rows of one doc_id with different texts are each
aligned on their own text; rows without a doc_id take no part and stay as they
are; extra columns are ignored, or kept where rows are returned.  A changed
passage all of whose seeds stand in other documents between it and its source,
the pairs of runs included, can be missed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from lexmill.llm.shared import binary_texts, materialize

SEED_WORDS = 5
MIN_WORDS = 50
WIDE = 32                        # words of a wide run
SPREAD = 25                      # words between the two runs of a pair
WIDTHS = (SEED_WORDS, WIDE, SPREAD + SEED_WORDS)   # words that a seed spans, by level
IDENTITY = 0.8
GAP = 0.1                        # cost of a word skipped on either side
MARGIN = 64                      # words beside a chain that an alignment may use
_LEAST_SPAN = 20                 # words between the ends of a chain
_REACH = 12                      # words between links on one diagonal that are one anchor
EQUAL = (SEED_WORDS, WIDE, SEED_WORDS)             # of which surely equal
_FLUSH = 700_000                 # seeds that a task packs at once
_BUCKET = 1_000_000              # seeds of a bucket
_HASH_BYTES = 6                  # of a hash, beside its bucket: one in 10^8 seeds meets another
_WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def word_hashes(text: bytes) -> np.ndarray:
    words = text.lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def seeds(words: np.ndarray, width: int = SEED_WORDS) -> np.ndarray:
    """Hashes of all runs of `width` words of one text, by position.

    A word, phrase or line said over and over, each time less than MIN_WORDS
    words on, gives equal seeds; they are counted, so the n-th of one text meets
    the n-th of another instead of all of them the first.
    """
    n = len(words) - width + 1
    h = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += words[i:i + n]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    order = np.argsort(h, kind="stable")
    again = np.concatenate(([False], (np.diff(h[order]) == 0) & (np.diff(order) < MIN_WORDS)))
    if again.any():
        steps = np.cumsum(again)
        steps -= np.maximum.accumulate(np.where(again, 0, steps))
        h[order] += steps.astype(np.uint64) * np.uint64(0x94D049BB133111EB)
    return h


def levels(words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash, position) of the seeds of one text of MIN_WORDS words at least, by level."""
    short = seeds(words)
    yield short, np.arange(len(short), dtype=np.int32)
    wide = seeds(words, WIDE)
    window = MIN_WORDS - WIDE + 1
    least = np.lib.stride_tricks.sliding_window_view(wide, window).argmin(axis=1) + np.arange(len(wide) - window + 1)
    at = np.unique(least).astype(np.int32)
    yield wide[at], at
    at = np.flatnonzero(short[:-SPREAD] & np.uint64(3) == 0).astype(np.int32)
    pair = (short[at] * np.uint64(0x9E3779B97F4A7C15)) ^ short[at + SPREAD]
    yield pair * np.uint64(0xBF58476D1CE4E5B9) ^ pair >> np.uint64(29), at


def _planes(values: np.ndarray, n: int) -> bytes:
    """The low n bytes of each value, all first bytes first: what is equal in
    neighbours compresses away."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1)[:, :n].T).tobytes()


def _unplaned(parts: list[bytes], n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    out = []
    for part in parts:
        flat = np.frombuffer(part, dtype=np.uint8).reshape(n, -1).T
        whole = np.zeros((len(flat), size), dtype=np.uint8)
        whole[:, :n] = flat
        out.append(whole.reshape(-1).view(kind))
    return np.concatenate(out)


def _steps(doc: np.ndarray, x: np.ndarray) -> tuple[bytes, bytes]:
    """Documents in runs and places, as steps from the value before."""
    d = np.diff(doc, prepend=0)
    d[0] = doc[0]
    places = np.where(np.concatenate(([True], d[1:] != 0)), x, np.diff(x, prepend=np.int32(0)))
    return _planes(d, 8), _planes(places.astype(np.int32), 4)


def _unstepped(docs: list[bytes], places: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for d, p in zip(docs, places):
        d, p = _unplaned([d], 8, np.int64), _unplaned([p], 4, np.int32).astype(np.int64)
        start = np.concatenate(([True], d[1:] != 0))
        total = np.cumsum(p)
        base = (total - p)[start][np.cumsum(start) - 1]
        out.append((np.cumsum(d), (total - base).astype(np.int32)))
    return tuple(map(np.concatenate, zip(*out)))


_PACKED = "bucket int, level int, hash binary, doc binary, x binary, src binary, y binary"
_PACKED_NAMES = ["bucket", "level", "hash", "doc", "x", "src", "y"]


def _packed_seeds(level: int, h: np.ndarray, doc: np.ndarray, x: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Seeds by bucket, the high half of the hash."""
    bucket = ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    bucket, h, doc, x = bucket[order], h[order], doc[order], x[order]
    edges = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(h)]))
    spans = list(zip(edges[:-1], edges[1:])) if len(h) else []
    columns = [(_planes(h[i:j], _HASH_BYTES), *_steps(doc[i:j], x[i:j])) for i, j in spans]
    hashes, docs, places = zip(*columns) if columns else ((), (), ())
    return pa.RecordBatch.from_arrays([
        pa.array(bucket[edges[:-1]] + level * buckets if spans else [], pa.int32()),
        pa.array([level] * len(spans), pa.int32()), *[pa.array(c, pa.binary()) for c in (hashes, docs, places)],
        *[pa.nulls(len(spans), pa.binary())] * 2], names=_PACKED_NAMES)


def _linked(h: np.ndarray, doc: np.ndarray, x: np.ndarray, level: int,
            buckets: int) -> tuple[np.ndarray, list[pa.RecordBatch]]:
    """(which occurrences are the first of their seed, packed links of the others)
    of seeds ordered by (doc, x).  The bucket of a link is that of its document,
    counted down from -1."""
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    first = np.ones(len(h), dtype=bool)
    first[order[1:][same]] = False
    order = order[np.concatenate(([False], same)) | np.concatenate((same, [False]))]      # seen twice
    h, doc, x = h[order], doc[order], x[order]
    if not len(h):
        return first, []
    at = np.arange(len(h))
    new = np.concatenate(([True], np.diff(h) != 0))
    least = np.maximum.accumulate(np.where(new, at, 0))
    start = new | np.concatenate(([True], np.diff(doc) != 0))       # of one document's occurrences
    own = np.maximum.accumulate(np.where(start, at, 0))
    before = own[np.maximum(own - 1, 0)]                            # first place in the document before
    links = [(at, least, (doc != doc[least]) | (x > x[least])), (at, before, (own > least) & (before > least))]
    i, j = (np.concatenate([ends[side][kept] for *ends, kept in links]) for side in (0, 1))
    if not len(i):
        return first, []
    bucket = (doc[i].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(buckets)
    order = np.lexsort((x[i], doc[i], bucket))
    bucket, i, j = bucket[order].astype(np.int32), i[order], j[order]
    edges = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(i)]))
    spans = [(i[p:q], j[p:q]) for p, q in zip(edges[:-1], edges[1:])]
    return first, [pa.RecordBatch.from_arrays([
        pa.array(-1 - bucket[edges[:-1]], pa.int32()), pa.array([level] * len(spans), pa.int32()),
        pa.nulls(len(spans), pa.binary()),
        *[pa.array(c, pa.binary()) for c in zip(*(_steps(doc[p], x[p]) for p, _ in spans))],
        pa.array([_planes(doc[q], 8) for _, q in spans], pa.binary()),
        pa.array([_planes(x[q], 4) for _, q in spans], pa.binary())], names=_PACKED_NAMES)]


def _seed_rows(buckets: int):
    """Packed seeds and links of (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, list]] = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            held.sort(key=lambda one: one[0])
            for level in range(len(WIDTHS)):
                h = np.concatenate([own[level][0] for _, own in held])
                x = np.concatenate([own[level][1] for _, own in held])
                doc = np.repeat(np.array([d for d, _ in held], dtype=np.int64), [len(own[level][0]) for _, own in held])
                first, links = _linked(h, doc, x, level, buckets)
                yield from links
                yield _packed_seeds(level, h[first], doc[first], x[first], buckets)
            held.clear()

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for doc, text in zip(ids, binary_texts(batch.column(1))):
                words = word_hashes(text)
                if len(words) < MIN_WORDS:
                    continue
                held.append((int(doc), list(levels(words))))
                size += len(words)
                if size >= _FLUSH:
                    yield from out()
                    size = 0
        if held:
            yield from out()
    return run


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """(bucket, its rows) of rows ordered by bucket."""
    held, last = [], None
    for batch in batches:
        for bucket, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and bucket != last:
                yield last, held
                held = []
            held.append(row)
            last = bucket
    if held:
        yield last, held


def _link_rows(buckets: int):
    """Packed links, by bucket of their document, of packed seeds ordered by
    bucket; links that are there pass on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def seeds_and_links() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                links = pc.less(batch.column("bucket"), 0)
                ready.append(batch.filter(links))
                yield batch.filter(pc.invert(links))

        ready: list[pa.RecordBatch] = []
        for _, rows in _by_bucket(seeds_and_links()):
            while ready:
                yield ready.pop()
            level, h, doc, x, _, _ = zip(*rows)
            h, (doc, x) = _unplaned(h, _HASH_BYTES, np.uint64), _unstepped(doc, x)
            order = np.lexsort((x, doc))
            yield from _linked(h[order], doc[order], x[order], level[0], buckets)[1]
        yield from ready
    return run


class _Best:
    """Fenwick tree for prefix maxima: (value, index) over ranks 1..n."""

    def __init__(self, n: int):
        self.value = [float("-inf")] * (n + 1)
        self.index = [-1] * (n + 1)

    def put(self, rank: int, value: float, index: int) -> None:
        while rank < len(self.value):
            if value > self.value[rank]:
                self.value[rank], self.index[rank] = value, index
            rank += rank & -rank

    def upto(self, rank: int) -> tuple[float, int]:
        value, index = float("-inf"), -1
        while rank > 0:
            if self.value[rank] > value:
                value, index = self.value[rank], self.index[rank]
            rank -= rank & -rank
        return value, index


def chain(x0, x1, y0, y1) -> list[list[int]]:
    """Best chains of anchors [x0, x1) ~ [y0, y1): lists of anchor indices.

    An anchor may follow one that ends, on both sides, before it starts.  Anchors
    enter the tree when the sweep over x has passed their end, so each look-up
    sees exactly the anchors that may stand before it.  Chains are read off
    backwards, the best first; an anchor belongs to one chain.
    """
    m = len(x0)
    if m == 1:
        return [[0]]
    ranks = {y: r for r, y in enumerate(sorted(set(y1)), start=1)}
    ends = sorted(ranks)
    score, before = [0.0] * m, [-1] * m
    tree = _Best(len(ends))
    waiting = sorted(range(m), key=lambda i: (x1[i], y1[i]))
    entered = 0
    for i in sorted(range(m), key=lambda i: (x0[i], y0[i])):
        while entered < m and x1[waiting[entered]] <= x0[i]:
            j = waiting[entered]
            tree.put(ranks[y1[j]], score[j] + GAP * (x1[j] + y1[j]), j)
            entered += 1
        low = int(np.searchsorted(ends, y0[i], side="right"))
        value, j = tree.upto(low)
        value -= GAP * (x0[i] + y0[i])
        score[i] = x1[i] - x0[i] + max(0.0, value)
        before[i] = j if value > 0 else -1
    taken, chains = [False] * m, []
    for i in sorted(range(m), key=lambda i: -score[i]):
        one = []
        while i >= 0 and not taken[i]:
            taken[i] = True
            one.append(i)
            i = before[i]
        if one:
            chains.append(one[::-1])
    return chains


def _uncovered(chains: list[tuple]) -> Iterator[tuple]:
    """(doc, src, anchors) of chains (doc, unsure, -words, src, anchors), without
    those inside a longer one of their document that is a passage for certain:
    a stretch of a text is reported with its longest source, not with each of the
    copies it stands in."""
    chains.sort()
    last, starts, ends = None, [], []
    for doc, unsure, _, src, anchors in chains:
        if doc != last:
            last, starts, ends = doc, [], []
        x0, x1 = anchors[0], anchors[-3]
        at = bisect_right(starts, x0)
        if at and ends[at - 1] >= x1:
            continue
        if not unsure:            # none holds another, so both bounds grow
            starts.insert(at, x0)
            ends.insert(at, x1)
        yield doc, src, anchors


_CHAINS = "doc long, src long, y_low int, y_high int, anchors array<int>"


def _chain_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chains of packed links ordered by bucket; a bucket has all links of its
    documents."""
    def settle(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        level, _, docs, places, sources, starts = zip(*rows)
        doc, x = _unstepped(docs, places)
        src, y = _unplaned(sources, 8, np.int64), _unplaned(starts, 4, np.int32)
        level = np.repeat(np.array(level, dtype=np.int32), [len(p) // 4 for p in places])
        order = np.lexsort((x, x - y, src, doc))
        doc, src, x, y, level = (c[order] for c in (doc, src, x, y, level))
        width, equal = np.array(WIDTHS, dtype=np.int32)[level], np.array(EQUAL, dtype=np.int32)[level]
        other = (np.diff(doc) != 0) | (np.diff(src) != 0) | (np.diff(x - y) != 0)
        line = np.concatenate(([0], np.cumsum(other))) << 32     # one number per diagonal
        end = np.maximum.accumulate(line + x + width) - line
        new = np.flatnonzero(other | (x[1:] > end[:-1] + _REACH)) + 1
        first = np.concatenate(([0], new))
        last = np.concatenate((new, [len(doc)])) - 1
        d, s = doc[first], src[first]
        x0, x1, y0, y1 = x[first], end[last], y[first], end[last] - x[last] + y[last]
        known = np.minimum(equal, np.where(np.append(other, True), equal, np.diff(x, append=0)))
        known = np.add.reduceat(known, first)       # words that are equal for certain
        pair = np.flatnonzero((np.diff(d) != 0) | (np.diff(s) != 0)) + 1
        out: list[tuple] = []
        starts = np.concatenate(([0], pair))
        wide = np.maximum.reduceat(x1, starts) - np.minimum.reduceat(x0, starts) >= _LEAST_SPAN
        for a, b in zip(starts[wide], np.concatenate((pair, [len(d)]))[wide]):
            if b - a > 1:
                parts = [x[a:b].tolist() for x in (x0, x1, y0, y1)]
            else:
                parts = [[int(x[a])] for x in (x0, x1, y0, y1)]
            for one in chain(*parts):
                span = parts[1][one[-1]] - parts[0][one[0]]
                if span >= _LEAST_SPAN:
                    anchors = [p[i] for i in one for p in parts]
                    longest = max(span, anchors[-1] - anchors[2])
                    sure = span >= MIN_WORDS and int(known[a:b][one].sum()) >= IDENTITY * longest
                    out.append((int(d[a]), not sure, -span, int(s[a]), anchors))
        out = [(doc, src, anchors[2] - MARGIN, anchors[-1] + MARGIN, anchors)
               for doc, src, anchors in _uncovered(out)]
        if out:
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                             names=["doc", "src", "y_low", "y_high", "anchors"])

    for _, rows in _by_bucket(batches):
        yield from settle(rows)


def _cut_source(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word hashes of the part of the source that an alignment may use."""
    known: tuple = (None, None)
    for batch in batches:
        parts = []
        text = batch.schema.get_field_index("text")
        for low, high, value in zip(batch.column("y_low").to_pylist(), batch.column("y_high").to_pylist(),
                                    binary_texts(batch.column(text))):
            if known[0] != value:
                known = (value, word_hashes(value))
            parts.append(known[1][max(0, low):max(0, high)].tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("doc", "src", "y_low", "anchors")] + [pa.array(parts, pa.binary())],
            names=["doc", "src", "y_low", "anchors", "part"])


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two short word lists."""
    if not len(a) or not len(b):
        return 0
    row = np.zeros(len(b) + 1, dtype=np.int32)
    for w in a:
        up = np.maximum(row[1:], row[:-1] + (b == w))
        row[1:] = np.maximum.accumulate(up)
    return int(row[-1])


def _grow(same: np.ndarray) -> int:
    """How far an end grows along its diagonal: +1 a match, -2 a mismatch,
    until the sum falls 8 below its best."""
    if not len(same) or not same.any():
        return 0
    total = np.cumsum(np.where(same, 1, -2))
    fallen = np.flatnonzero(np.maximum.accumulate(total) - total > 8)
    if len(fallen):
        total = total[:fallen[0]]
    if not len(total) or total.max() <= 0:
        return 0
    return int(total.argmax()) + 1


def align(a: np.ndarray, b: np.ndarray, anchors: list[tuple[int, int, int, int]],
          min_words: int = MIN_WORDS, identity: float = IDENTITY) -> list[tuple]:
    """Passages (x0, x1, y0, y1, matched) of one chain of anchors (x0, x1, y0,
    y1) between the word lists a and b."""
    if not anchors or anchors[0][0] < 0 or anchors[-1][1] > len(a) or anchors[-1][3] > len(b):
        return []
    x0, x1, y0, y1 = anchors[0][0], anchors[-1][1], anchors[0][2], anchors[-1][3]
    room = min(x0, y0, MARGIN)
    back = _grow((a[x0 - room:x0] == b[y0 - room:y0])[::-1])
    room = min(len(a) - x1, len(b) - y1, MARGIN)
    on = _grow(a[x1:x1 + room] == b[y1:y1 + room])
    inside = [int((a[p:q] == b[r:s]).sum()) for p, q, r, s in anchors]
    inside[0] += int((a[x0 - back:x0] == b[y0 - back:y0]).sum())
    inside[-1] += int((a[x1:x1 + on] == b[y1:y1 + on]).sum())
    gaps = [_common(a[p[1]:q[0]], b[p[3]:q[2]]) for p, q in zip(anchors, anchors[1:])]
    out, todo = [], [(0, len(anchors))]
    while todo:
        i, j = todo.pop()
        lx, ly = (back, back) if i == 0 else (0, 0)
        rx = on if j == len(anchors) else 0
        span = (anchors[i][0] - lx, anchors[j - 1][1] + rx, anchors[i][2] - ly, anchors[j - 1][3] + rx)
        length = max(span[1] - span[0], span[3] - span[2])
        matched = sum(inside[i:j]) + sum(gaps[i:j - 1])
        if span[1] - span[0] < min_words:
            continue
        if matched >= identity * length:
            out.append((*span, matched))
        elif j - i > 1:
            lost = [max(anchors[g + 1][0] - anchors[g][1], anchors[g + 1][2] - anchors[g][3]) - gaps[g]
                    for g in range(i, j - 1)]
            at = i + 1 + int(np.argmax(lost))
            todo += [(i, at), (at, j)]
    return out


_SPANS = ("doc_id long, row long, start int, end int, source_id long, source_start int, "
          "source_end int, matched int")


def _align_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: tuple = (None, None)
    for batch in batches:
        out = []
        text = batch.schema.get_field_index("text")
        for doc, row, src, low, flat, part, value in zip(
                *(batch.column(c).to_pylist() for c in ("doc", "row", "src", "y_low", "anchors", "part")),
                binary_texts(batch.column(text))):
            if known[0] != value:
                known = (value, word_hashes(value))
            low = max(0, low)
            anchors = [(flat[i], flat[i + 1], flat[i + 2] - low, flat[i + 3] - low)
                       for i in range(0, len(flat), 4)]
            for x0, x1, y0, y1, matched in align(known[1], np.frombuffer(part, dtype=np.uint64), anchors):
                out.append((doc, row, x0, x1, src, y0 + low, y1 + low, matched))
        if out:
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(),
                     pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                names=["doc_id", "row", "start", "end", "source_id", "source_start", "source_end", "matched"])


def bucket_count(texts: DataFrame) -> int:
    """Buckets of about _BUCKET seeds: a word is seldom shorter than five bytes
    with its blank."""
    octets = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-octets // (5 * _BUCKET)))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, row, start, end, source_id, source_start, source_end, matched):
    every passage of a document that stands earlier in the corpus, in a document
    of smaller doc_id or further up in the same one.  Bounds count words, ends
    are exclusive; `row` is the hash of doc_id and text."""
    texts = docs.filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text")
    buckets = bucket_count(texts)
    packed = texts.mapInArrow(_seed_rows(buckets), _PACKED)
    links = packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_link_rows(buckets), _PACKED)
    ordered = links.repartition("bucket").sortWithinPartitions("bucket")
    chains = materialize(ordered.mapInArrow(_chain_rows, _CHAINS), "chains")
    parts = chains.join(texts, chains.src == texts.doc_id).select(*chains.columns, "text").mapInArrow(
        _cut_source, "doc long, src long, y_low int, anchors array<int>, part binary")
    both = parts.join(texts, parts.doc == texts.doc_id).select(
        *parts.columns, "text", F.xxhash64("doc_id", "text").alias("row"))
    return both.mapInArrow(_align_rows, _SPANS).distinct()


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """`text` without the words of the spans; what stands between kept words
    stays as it is."""
    at = [m.span() for m in _WORD.finditer(text)]
    gone = bytearray(len(at))
    for start, end in spans:
        gone[start:end] = b"\x01" * (min(end, len(at)) - start)
    out, place, i = [], 0, 0
    while i < len(at):
        if not gone[i]:
            i += 1
            continue
        j = i
        while j < len(at) and gone[j]:
            j += 1
        out.append(text[place:at[i][0]])
        place = at[j][0] if j < len(at) else len(text)
        i = j
    out.append(text[place:])
    return b"".join(out)


def _cut_rows(text_at: int, spans_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for whole, spans in zip(batch.column(text_at), batch.column(spans_at)):
                whole, spans = whole.as_py(), spans.as_py()
                if spans:
                    whole = cut(whole.encode(), [(s["start"], s["end"]) for s in spans]).decode()
                texts.append(whole)
            columns = list(batch.columns)
            columns[text_at] = pa.array(texts, pa.string())
            columns[spans_at] = batch.column(spans_at).is_valid()
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "__cut"])
    return run


def without_repeats(docs: DataFrame) -> DataFrame:
    """`docs` with every repeated passage cut out of all but its first place.
    Documents of which nothing is left go; `n_chars` follows the new text."""
    spans = repeated_passages(docs).groupBy("doc_id", "row").agg(
        F.collect_list(F.struct("start", "end")).alias("__spans"))
    spans = spans.select(F.col("doc_id").alias("__doc"), F.col("row").alias("__row"), "__spans")
    names = docs.columns
    met = docs.join(spans, (docs.doc_id.cast("long") == spans["__doc"])
                    & (F.xxhash64(docs.doc_id.cast("long"), docs.text) == spans["__row"]), "left")
    met = met.select(*[docs[c] for c in names], "__spans")
    kinds = T.StructType([*docs.schema.fields, T.StructField("__cut", T.BooleanType())])
    done = met.mapInArrow(_cut_rows(names.index("text"), len(names)), kinds)
    if "n_chars" in names:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        done = done.withColumn("n_chars", F.when(F.col("__cut"), length).otherwise(F.col("n_chars")))
    return done.filter(~F.col("__cut") | F.col("text").rlike(r"[^\x20\x09-\x0d]")).select(*names)
