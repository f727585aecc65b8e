"""Alignment of two tokenizers by an associative monoid of fragments.

A group is the stretch between two byte offsets where tokens of both tokenizers
end.  A fragment is what a byte range says about its groups: an open prefix (the
tokens up to its first common end), closed groups, and an open suffix (those
after its last).  A token belongs to the range in which it starts.  Two
neighbouring fragments compose: the suffix of the left and the prefix of the right
are laid together, common ends that appear there close groups, and the rest is
as it was.  The operation is associative, so fragments are reduced as a tree.

1. Texts up to CHUNK_BYTES are one range and are aligned where they are read.
   Longer ones are cut into byte ranges, which are dealt over the tasks, encoded
   there, and composed FAN at a time, level by level.  Closed groups leave the
   tree as soon as they are closed: what climbs is two open ends per fragment.
   Neither tokenizer has a token that goes on over a blank between two visible
   characters, so a range is encoded from the blank before to the blank behind
   it; a stretch without such blanks that is longer than a range stays in one.
2. Link pairs (A id, B id) are counted once per document: pre-aggregated where a
   document is one range, after a distinct by document where it is several.
3. Counts are looked up by document: the HEAD_PAIRS most frequent pairs are
   broadcast, which is a bounded table, the rest is joined, so that no frequent
   pair is a hot key.  Sums per document end the work.
4. The digest over all groups of a long document is taken as a stream over its
   closed groups, in order.

Cases: a null or empty text, and a text that either tokenizer does not give back
byte for byte, has no tokens: zeros and an empty digest; repeated rows and rows
without a doc_id are documents of their own; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexmill.llm.shared import materialize

FOLDER = "/opt/tokenizers"
TOKENIZER_A = f"{FOLDER}/byte_bpe_50k.json"
TOKENIZER_B = f"{FOLDER}/piece_bpe_32k.model"
CHUNK_BYTES = 1 << 16
FAN = 16
HEAD_PAIRS = 1 << 18
_AT_ONCE = 1_500_000        # characters that a task aligns at once
_FEW = 64                   # links of a group that are written out one by one
_HELD = 1_000_000           # pairs that a task holds before it hands them on
_SEAM = re.compile(r"(?<=\S) (?=\S)")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")

# One side of an open end: token ids and the byte offsets where the tokens end.
Ends = tuple[np.ndarray, np.ndarray]


def _byte_level() -> dict[str, int]:
    """Characters of a byte-level vocabulary and their bytes: visible Latin-1
    characters stand for themselves, the others for U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


# How a byte-level vocabulary splits text before its merges; a fixed value.
_PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _encoder(path: str):
    """(text -> ids, bytes of every id) of a byte-level tokenizer file.  Where
    its merges make its ids in order, as a rank file does, the ranks are read from
    it; any other is left to its own library."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    vocabulary, of = model["model"]["vocab"], _byte_level()
    known = {i: bytes(map(of.__getitem__, token)) for token, i in vocabulary.items() if all(c in of for c in token)}
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["model"]["merges"]]
    if [vocabulary[m] for m in merged] == list(range(256, 256 + len(merged))):
        from tiktoken import Encoding

        ranks = {known[i]: i for i in range(256 + len(merged))}
        return Encoding("ranks", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, known
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    return lambda text: own.encode(text, add_special_tokens=False).ids, known


class Pair:
    """Both tokenizers, with the bytes of every token."""

    def __init__(self, path_a: str = TOKENIZER_A, path_b: str = TOKENIZER_B):
        from sentencepiece import SentencePieceProcessor

        self.a, self.bytes_a = _encoder(path_a)
        self.b = SentencePieceProcessor(model_file=path_b)
        self.bytes_b = {}
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            found = _BYTE_PIECE.fullmatch(piece) if self.b.is_byte(i) else None
            self.bytes_b[i] = bytes([int(found[1], 16)]) if found else piece.replace("▁", " ").encode()
        self.widths = tuple(np.array([len(of.get(i, b"")) for i in range(max(of) + 1)], dtype=np.int64)
                            for of in (self.bytes_a, self.bytes_b))

    def encode(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """A ids of blank + part and B ids of part, which adds the blank."""
        return [self.a(" " + p) for p in parts], self.b.encode(parts, num_threads=1)

    def given_back(self, part: str, ids_a: list[int], ids_b: list[int]) -> bool:
        """Whether the bytes of both token lists are those of blank + part."""
        whole = b" " + part.encode()
        return (b"".join(map(self.bytes_a.__getitem__, ids_a)) == whole
                and b"".join(map(self.bytes_b.__getitem__, ids_b)) == whole)


# --- the monoid -------------------------------------------------------------

_NOTHING = (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))
EMPTY = (_NOTHING, _NOTHING)


def _joined(x: tuple[Ends, Ends], y: tuple[Ends, Ends]) -> tuple[Ends, Ends]:
    return tuple((np.concatenate((a, c)), np.concatenate((b, d))) for (a, b), (c, d) in zip(x, y))


def _parts(tokens: tuple[Ends, Ends], cuts: list[int]) -> list[tuple[Ends, Ends]]:
    """The tokens up to each of the cuts, and those behind the last."""
    (a, ea), (b, eb) = tokens
    i, j = np.searchsorted(ea, cuts, side="right"), np.searchsorted(eb, cuts, side="right")
    i, j = [0, *i.tolist(), len(a)], [0, *j.tolist(), len(b)]
    return [((a[p:q], ea[p:q]), (b[r:s], eb[r:s])) for p, q, r, s in zip(i, i[1:], j, j[1:])]


class Fragment:
    """Open prefix, stretches of closed groups, open suffix.  A fragment without a
    common end is all prefix."""

    def __init__(self, head: tuple[Ends, Ends], closed: list, tail: tuple[Ends, Ends], cut: bool, sound: bool = True):
        self.head, self.closed, self.tail, self.cut, self.sound = head, closed, tail, cut, sound

    @classmethod
    def of(cls, tokens: tuple[Ends, Ends], sound: bool = True) -> Fragment:
        cuts = np.intersect1d(tokens[0][1], tokens[1][1], assume_unique=True)
        if not len(cuts):
            return cls(tokens, [], EMPTY, False, sound)
        first, groups, rest = _parts(tokens, [cuts[0], cuts[-1]])
        return cls(first, [groups] if len(cuts) > 1 else [], rest, True, sound)

    def then(self, other: Fragment) -> Fragment:
        between = Fragment.of(_joined(self.tail if self.cut else self.head, other.head))
        sound = self.sound and other.sound
        if not self.cut:
            tail = other.tail if other.cut else between.tail
            return Fragment(between.head, between.closed + other.closed, tail, between.cut, sound)
        if not between.cut:
            return Fragment(self.head, self.closed, between.head, True, sound)
        closed = [*self.closed, between.head, *between.closed, *other.closed]
        return Fragment(self.head, closed, other.tail if other.cut else between.tail, True, sound)

    def dump(self) -> bytes:
        arrays = [x for ends in (self.head, self.tail) for side in ends for x in side]
        sizes = np.array([self.cut, self.sound, *map(len, arrays)], dtype=np.int64)
        return sizes.tobytes() + b"".join(x.tobytes() for x in arrays)

    @classmethod
    def load(cls, blob: bytes) -> Fragment:
        values = np.frombuffer(blob, dtype=np.int64)
        cut, sound, *sizes = values[:10].tolist()
        edges = np.cumsum([10, *sizes])
        h = [values[i:j] for i, j in zip(edges, edges[1:])]
        return cls(((h[0], h[1]), (h[2], h[3])), [], ((h[4], h[5]), (h[6], h[7])), bool(cut), bool(sound))


# --- closed groups and their links ------------------------------------------

class Groups:
    """The groups of tokens that end together: `text` of each, token counts `a`
    and `b`, the place of their last A token, and their links as (group, key,
    times), where a key is A id and B id."""

    def __init__(self, tokens: tuple[Ends, Ends]):
        (a, ea), (b, eb) = tokens
        at = np.searchsorted(eb, ea)
        last_a = np.flatnonzero(eb[np.minimum(at, len(eb) - 1)] == ea) if len(eb) else np.empty(0, dtype=np.int64)
        last_b = at[last_a]
        self.last = last_a
        from_a, from_b = (np.concatenate(([0], x[:-1] + 1)).astype(np.int64)[:len(x)] for x in (last_a, last_b))
        self.a, self.b = last_a + 1 - from_a, last_b + 1 - from_b
        said_a, said_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        self.text = [f"{','.join(said_a[i:j + 1])}|{','.join(said_b[k:m + 1])}" for i, j, k, m in
                     zip(from_a.tolist(), last_a.tolist(), from_b.tolist(), last_b.tolist())]
        links = self.a * self.b
        few = np.flatnonzero(links <= _FEW)
        group, rank = _ragged(few, links[few])
        keys = a[from_a[group] + rank // self.b[group]] << 32 | b[from_b[group] + rank % self.b[group]]
        groups, all_keys, times = [group], [keys], [np.ones(len(keys), dtype=np.int64)]
        for g in np.flatnonzero(links > _FEW):       # a long group repeats its ids: count them first
            x, many_x = np.unique(a[from_a[g]:last_a[g] + 1], return_counts=True)
            y, many_y = np.unique(b[from_b[g]:last_b[g] + 1], return_counts=True)
            all_keys.append((x[:, None] << 32 | y[None, :]).ravel())
            times.append((many_x[:, None] * many_y[None, :]).ravel())
            groups.append(np.full(len(all_keys[-1]), g))
        self.group, self.keys, self.times = map(np.concatenate, (groups, all_keys, times))


def _ragged(items: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every item as often as its size says, and 0, 1, … within each."""
    each = np.repeat(items, sizes)
    return each, np.arange(len(each)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def summed(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their times."""
    if not keys:
        return _NOTHING
    keys, at = np.unique(np.concatenate(keys), return_inverse=True)
    out = np.zeros(len(keys), dtype=np.int64)
    np.add.at(out, at, np.concatenate(times))
    return keys, out


def _planes(values: np.ndarray) -> bytes:
    """All first bytes, all second bytes, …: high bytes that are zero compress away."""
    return np.ascontiguousarray(values.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplaned(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, dtype=np.uint8).reshape(8, -1).T).reshape(-1).view(np.int64)


_RECORD = {"row": pa.int64(), "doc_id": pa.int64(), "kind": pa.string(), "idx": pa.int64(), "place": pa.int64(),
           "blob": pa.binary(), "sha": pa.string(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(),
           "n_links": pa.int64(), "keys": pa.binary(), "times": pa.binary()}
_RECORD_SCHEMA = pa.schema(list(_RECORD.items()))
_RECORD_DDL = ("row long, doc_id long, kind string, idx long, place long, blob binary, sha string, n_a long, n_b long, "
               "n_groups long, n_links long, keys binary, times binary")


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_RECORD_SCHEMA)


def _closed_row(row: int, stretch: tuple[Ends, Ends]) -> dict:
    """A stretch of closed groups of a long document as a row; its place orders it."""
    one = Groups(stretch)
    keys, times = summed([one.keys], [one.times])
    return {"row": row, "kind": "closed", "place": int(stretch[0][1][0]), "blob": ";".join(one.text).encode(),
            "n_a": int(one.a.sum()), "n_b": int(one.b.sum()), "n_groups": len(one.text),
            "n_links": int((one.a * one.b).sum()), "keys": _planes(keys), "times": _planes(times)}


class Segments:
    """Alignment of distinct segments, the stretches between seams, laid end to
    end: `of` numbers the sound ones, `tokens` are their tokens with ends from the
    start of all, `groups` their groups."""

    def __init__(self, pair: Pair, parts):
        parts = list(dict.fromkeys(parts))
        ids = pair.encode(parts) if parts else ([], [])
        said = [p.encode() for p in parts]
        size = np.array([len(p) + 1 for p in said], dtype=np.int64)
        whole, sound = b"".join([b" " + p for p in said]), True
        tokens, self.edges = [], []
        for own, of, widths in zip(ids, (pair.bytes_a, pair.bytes_b), pair.widths):
            count = np.fromiter(map(len, own), dtype=np.int64, count=len(own))
            flat = np.fromiter(chain.from_iterable(own), dtype=np.int64, count=int(count.sum()))
            ends, edges = np.cumsum(widths[flat]), np.concatenate(([0], np.cumsum(count)))
            at = np.concatenate(([0], ends))[edges]
            sound = (sound and np.array_equal(np.diff(at), size)
                     and b"".join(map(of.__getitem__, chain.from_iterable(own))) == whole)
            tokens.append((flat, ends))
            self.edges.append(edges)
        if not sound:
            return self.__init__(pair, [p for p, *own in zip(parts, *ids) if pair.given_back(p, *own)])
        self.of = {p: i for i, p in enumerate(parts)}
        self.size = size
        self.tokens = tuple(tokens)
        self.groups = Groups(self.tokens)
        # every segment ends a group
        group_edges = np.searchsorted(self.groups.last, self.edges[0])
        self.text = [";".join(self.groups.text[i:j]) for i, j in zip(group_edges.tolist(), group_edges[1:].tolist())]
        links = np.concatenate(([0], np.cumsum(self.groups.a * self.groups.b)))[group_edges]
        self.sums = np.stack([*map(np.diff, self.edges), np.diff(group_edges), np.diff(links)])
        order = np.argsort(self.groups.group, kind="stable")
        self.keys, self.times = self.groups.keys[order], self.groups.times[order]
        self.key_edges = np.searchsorted(self.groups.group[order], group_edges)

    def laid(self, parts: list[str], at: int) -> list[tuple]:
        """(ids, ends, starts) of both sides of segments in a row from byte `at`."""
        which = np.array([self.of[p] for p in parts], dtype=np.int64)
        begin = np.concatenate(([0], np.cumsum(self.size)))[which]
        shift = at + np.concatenate(([0], np.cumsum(self.size[which])[:-1])) - begin
        out = []
        for (ids, ends), edges in zip(self.tokens, self.edges):
            count = np.diff(edges)[which]
            each, rank = _ragged(np.arange(len(which)), count)
            place = edges[which][each] + rank
            ends = ends[place] + shift[each]
            out.append((ids[place], ends, np.concatenate(([at], ends[:-1]))))
        return out


def _whole_rows(first: int, ids: list, docs: list[list[str]], found: Segments) -> list[dict]:
    """Documents of one range: their segments begin and end at common ends, so
    their fragments are all closed."""
    rows = [{"row": first + i, "doc_id": doc_id, "kind": "whole", "sha": "", "n_a": 0, "n_b": 0, "n_groups": 0,
             "n_links": 0, "keys": b"", "times": b""} for i, doc_id in enumerate(ids)]
    which = [[found.of.get(p, -1) for p in parts] for parts in docs]
    sound = [i for i, x in enumerate(which) if x and min(x) >= 0]
    if not sound:
        return rows
    doc = np.repeat(sound, [len(which[i]) for i in sound])
    seg = np.fromiter(chain.from_iterable(which[i] for i in sound), dtype=np.int64, count=len(doc))
    once, many = np.unique(doc * len(found.of) + seg, return_counts=True)
    doc, seg = np.divmod(once, len(found.of))
    each, rank = _ragged(np.arange(len(seg)), np.diff(found.key_edges)[seg])
    place = found.key_edges[seg][each] + rank
    key, times, of = found.keys[place], found.times[place] * many[each], doc[each]
    order = np.lexsort((key, of))
    key, times, of = key[order], times[order], of[order]
    new = np.flatnonzero(np.concatenate(([True], (np.diff(key) != 0) | (np.diff(of) != 0))))
    key, times, of = key[new], np.add.reduceat(times, new), of[new]
    for i in sound:
        sums = found.sums[:, which[i]].sum(axis=1).tolist()
        low, high = np.searchsorted(of, [i, i + 1])
        rows[i].update(zip(("n_a", "n_b", "n_groups", "n_links"), sums),
                       sha=hashlib.sha256(";".join([found.text[k] for k in which[i]]).encode()).hexdigest(),
                       keys=_planes(key[low:high]), times=_planes(times[low:high]))
    return rows


def byte_ranges(text: str, size: int) -> list[tuple[int, int, int, str]]:
    """(low, high, start, region): the ranges of about `size` bytes of blank + text,
    and the segments each touches, which start at byte `start`.  No range ends in
    a segment longer than `size`, and only the first can be shorter than a blank."""
    parts = _SEAM.split(text)
    edges = np.cumsum([0, *(len(p.encode()) + 1 for p in parts)])
    total, bounds = int(edges[-1]), [0]
    for bound in range(size, total, size):
        i = int(np.searchsorted(edges, bound, side="right")) - 1
        if edges[i + 1] - edges[i] <= size and bound > bounds[-1]:
            bounds.append(bound)
    out = []
    for low, high in zip(bounds, [*bounds[1:], total]):
        i = int(np.searchsorted(edges, low, side="right")) - 1
        j = int(np.searchsorted(edges, high, side="left"))
        out.append((low, high, int(edges[i]), " ".join(parts[i:j])))
    return out


def _read(path_a: str, path_b: str, chunk_bytes: int):
    """Records of (doc_id, text): `whole` for a document of one range, `range`
    with its region for each range of a longer one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pair = Pair(path_a, path_b)
        row = TaskContext.get().partitionId() << 40
        ids, docs, rows, size = [], [], [], 0

        def out() -> pa.RecordBatch:
            nonlocal row
            done = rows + _whole_rows(row, ids, docs, Segments(pair, chain.from_iterable(docs)))
            row += len(ids)
            for held in (ids, docs, rows):
                held.clear()
            return _batch(done)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                size += len(text)
                if len(text) * 4 < chunk_bytes or len(text.encode()) < chunk_bytes:
                    ids.append(doc_id)
                    docs.append(_SEAM.split(text) if text else [])
                else:
                    for idx, (low, high, start, region) in enumerate(byte_ranges(text, chunk_bytes)):
                        rows.append({"row": row, "doc_id": doc_id if not idx else None, "kind": "range", "idx": idx,
                                     "place": start, "n_a": low, "n_b": high, "blob": region.encode()})
                    row += 1
                if size > _AT_ONCE:
                    yield out()
                    size = 0
        yield out()
    return run


def _encode(path_a: str, path_b: str):
    """Records of ranges: an `open` fragment and a `closed` row each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(path_a, path_b)
        for batch in batches:
            for r in batch.select(["row", "idx", "place", "n_a", "n_b", "blob"]).to_pylist():
                parts = _SEAM.split(r["blob"].decode())
                found = Segments(pair, parts)
                if len(found.of) < len(set(parts)):
                    yield _batch([_open_row(r["row"], r["idx"], Fragment(EMPTY, [], EMPTY, False, False))])
                    continue
                owned = []
                for ids, ends, starts in found.laid(parts, r["place"]):
                    mine = (starts >= r["n_a"]) & (starts < r["n_b"])
                    owned.append((ids[mine], ends[mine]))
                one = Fragment.of(tuple(owned))
                yield _batch([_open_row(r["row"], r["idx"], one)] + [_closed_row(r["row"], x) for x in one.closed])
    return run


def _open_row(row: int, idx: int, one: Fragment) -> dict:
    return {"row": row, "kind": "open", "idx": idx, "blob": one.dump()}


def _compose(key, table):
    """Up to FAN neighbouring fragments become one; the groups that close there
    leave as a row."""
    rows = sorted(table.select(["row", "idx", "blob"]).to_pylist(), key=lambda r: r["idx"])
    whole = Fragment.load(rows[0]["blob"])
    for r in rows[1:]:
        whole = whole.then(Fragment.load(r["blob"]))
    out = [_open_row(rows[0]["row"], rows[0]["idx"] // FAN, whole)]
    out += [_closed_row(rows[0]["row"], stretch) for stretch in whole.closed]
    return pa.Table.from_batches([_batch(out)])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`closed` rows of roots: the prefix of a whole document is a group.  A
    document that is not given back whole leaves an `unsound` row."""
    for batch in batches:
        rows = []
        for row, blob in zip(batch.column("row").to_pylist(), batch.column("blob").to_pylist()):
            one = Fragment.load(blob)
            if one.sound:
                rows.append(_closed_row(row, one.head))
            else:
                rows.append({"row": row, "kind": "unsound"})
        yield _batch(rows)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, sha) of closed rows ordered by (row, place), as a stream."""
    last, digest = None, None
    for batch in batches:
        out = []
        for row, text in zip(batch.column("row").to_pylist(), batch.column("blob")):
            if row != last:
                if digest:
                    out.append((last, digest.hexdigest()))
                last, digest = row, hashlib.sha256()
            else:
                digest.update(b";")
            digest.update(text.as_py())
        rows, shas = zip(*out) if out else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(shas, pa.string())], names=["row", "sha"])
    if digest:
        yield pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), pa.array([digest.hexdigest()])],
                                         names=["row", "sha"])


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, docs) of the pairs of whole documents, partial sums."""
    held, size = [], 0

    def out() -> pa.RecordBatch:
        keys, docs = summed(held, [np.ones(len(k), dtype=np.int64) for k in held])
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(docs)], names=["key", "docs"])

    for batch in batches:
        for blob in batch.column(0):
            held.append(_unplaned(blob.as_py()))
            size += len(held[-1])
            if size > _HELD:
                yield out()
                size = 0
    yield out()


def _each_pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, key) of the pairs of closed rows."""
    for batch in batches:
        for row, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
            keys = _unplaned(blob.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), row)), pa.array(keys)], names=["row", "key"])


def _look_up(head):
    """Sums of each record over the pairs of the broadcast head, under a negative
    key of its own, and a row for every pair that is not in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, best = head.value
        names = ["row", "key", "times", "n_best", "count_sum"]
        for batch in batches:
            rows, left = [], []
            for row, k, t in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                k, t = _unplaned(k.as_py()), _unplaned(t.as_py())
                at = np.minimum(np.searchsorted(keys, k), max(0, len(keys) - 1))
                known = keys[at] == k if len(keys) else np.zeros(len(k), dtype=bool)
                at, seen = at[known], t[known]
                rows.append((row, -1 - row, 0, int((seen * best[at]).sum()), int((seen * docs[at]).sum())))
                if not known.all():
                    left.append((np.full((~known).sum(), row), k[~known], t[~known]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)
            if left:
                columns = [np.concatenate(c) for c in zip(*left)]
                none = np.zeros(len(columns[0]), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*columns, none, none)], names=names)
    return run


def _records(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(whole documents, closed rows of long ones), and what else is known of
    long ones rides along: their ids and digests."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    read = materialize(texts.mapInArrow(_read(path_a, path_b, chunk_bytes), _RECORD_DDL), "alignment")
    whole = read.filter(F.col("kind") == "whole")
    ranges = read.filter(F.col("kind") == "range")
    most = ranges.agg(F.max("idx")).first()[0]
    if most is None:
        return whole, None
    level = materialize(ranges.repartition("row", "idx").mapInArrow(_encode(path_a, path_b), _RECORD_DDL), "fragments")
    closed, most = [level.filter(F.col("kind") == "closed")], int(most)
    while most:
        ends = level.filter(F.col("kind") == "open").groupBy("row", F.floor(F.col("idx") / FAN).alias("next"))
        level = materialize(ends.applyInArrow(_compose, _RECORD_DDL), "fragments")
        closed.append(level.filter(F.col("kind") == "closed"))
        most //= FAN
    roots = materialize(level.filter(F.col("kind") == "open").mapInArrow(_finish, _RECORD_DDL), "roots")
    closed.append(roots.filter(F.col("kind") == "closed"))
    long = closed[0]
    for part in closed[1:]:
        long = long.union(part)
    unsound = roots.filter(F.col("kind") == "unsound").select("row")
    long = materialize(long.join(unsound, "row", "left_anti").select(*_RECORD), "closed")
    digests = long.select("row", "place", "blob").repartition("row").sortWithinPartitions("row", "place").mapInArrow(
        _digests, "row long, sha string")
    zero = [F.lit(0).cast("long").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")]
    known = ranges.filter(F.col("idx") == 0).select("row", "doc_id").join(digests, "row", "left").select(
        "row", "doc_id", F.coalesce("sha", F.lit("")).alias("sha"), *zero)
    return whole, (long, known)


def aligned(docs: DataFrame, path_a: str = TOKENIZER_A, path_b: str = TOKENIZER_B,
            chunk_bytes: int = CHUNK_BYTES, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)."""
    spark = docs.sparkSession
    whole, rest = _records(docs, path_a, path_b, chunk_bytes)
    counts = whole.select("keys").mapInArrow(_count_pairs, "key long, docs long")
    facts = ["row", "doc_id", "sha", "n_a", "n_b", "n_groups", "n_links"]
    known, linked = whole.select(*facts), whole.select("row", "keys", "times")
    if rest:
        long, names = rest
        own = long.select("row", "keys").mapInArrow(_each_pair, "row long, key long").distinct()
        counts = counts.union(own.groupBy("key").agg(F.count(F.lit(1)).alias("docs")))
        none = F.lit(None)
        known = known.union(names).union(long.select(
            "row", none.cast("long"), none.cast("string"), "n_a", "n_b", "n_groups", "n_links"))
        linked = linked.union(long.select("row", "keys", "times"))
    pairs = materialize(counts.groupBy("key").agg(F.sum("docs").alias("docs")), "pairs")
    a = F.shiftright("key", 32)
    highest = pairs.groupBy(a.alias("a")).agg(F.max("docs").alias("highest"))
    scored = materialize(pairs.withColumn("a", a).join(highest, "a").select(
        "key", "docs", (F.col("docs") == F.col("highest")).cast("long").alias("best")), "pairs")
    top = scored.orderBy(F.desc("docs"), "key").limit(head_pairs).toArrow().sort_by("key")
    head = spark.sparkContext.broadcast(tuple(top.column(c).to_numpy() for c in ("key", "docs", "best")))
    looked = linked.mapInArrow(_look_up(head), "row long, key long, times long, n_best long, count_sum long")
    met = looked.join(scored, "key", "left").select(
        "row", (F.col("n_best") + F.coalesce(F.col("times") * F.col("best"), F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce(F.col("times") * F.col("docs"), F.lit(0))).alias("count_sum"))
    zero, none = F.lit(0).cast("long"), F.lit(None)
    every = known.select(*facts, zero.alias("n_best"), zero.alias("count_sum")).union(met.select(
        "row", none.cast("long"), none.cast("string"), zero, zero, zero, zero, "n_best", "count_sum"))
    sums = [F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return every.groupBy("row").agg(F.max("doc_id").alias("doc_id"), *sums, F.max("sha").alias("groups_sha256")).drop("row")
