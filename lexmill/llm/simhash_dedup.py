"""SimHash near-duplicates through Gray-order hierarchical indexes.

1. A fingerprint per document, in the task that reads it.
2. Equal fingerprints fold to one node before anything is compared, so a group
   of exact copies is one row from here on.
3. Exact blocking: two 64-bit values that differ in at most 3 bits agree in one
   of four 16-bit blocks and, over the other 48 bits, in one of four 12-bit
   parts.  Each distinct value is filed under its 16 (block, part) keys of 28
   shared bits, 16 narrow rows.
4. The rows are ranged by (key, Gray rank).  Neighbours in Gray order share many
   bits, so each key's run is cut into leaves, whose shared bits form a mask and
   a pattern; upper nodes factor the masks of eight children each.  A pair of
   nodes is dropped, with all below it, once the bits it has fixed on both sides
   differ in more than the radius; what survives is compared exactly.
5. A key that spans several tasks leaves blocks of its run, with mask and
   pattern, and blocks of one key meet in a join pruned by the same rule.
6. Each task emits a spanning forest of its links, never all pairs; the
   components of the forest are the near-duplicate groups.

Cases: a null text is empty; empty texts have fingerprint zero and link like any
other; a null doc_id keeps its row and names a component only where no other id
is reachable (then null); repeated rows each get their row back; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lexmill.llm.components import connected_components
from lexmill.llm.shared import binary_texts, materialize, popcount, resolve_pairs

SHINGLE = 3
RADIUS = 3
SEED = 42
LEAF = 32       # values in a leaf of the index
FAN = 8         # children of an upper node
BLOCK = 4096    # values in a block that is compared across tasks
_CHUNK = 1 << 16


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of one UTF-8 text, repeats included.

    `bytes.lower` and `bytes.split` touch exactly A-Z and the six ASCII spaces.
    """
    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return digest(b" ".join(words), SEED)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
    n = len(words) - size + 1
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype=">u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _CHUNK):
        bits = np.unpackbits(hashes[at:at + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp long): one row per row of `docs`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint(t, size) for t in binary_texts(batch.column(1))),
                                 dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values.view(np.int64))], names=["doc_id", "fp"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def _gray_rank(fp: Column) -> Column:
    """Position of a value in the reflected Gray sequence, ordered as unsigned."""
    rank = fp
    for step in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, step))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


def _keys(fp: Column) -> Column:
    """The 16 (block, part) keys of a value."""
    keys = []
    for block in range(4):
        head = F.shiftrightunsigned(fp, 16 * block).bitwiseAND(F.lit(0xFFFF))
        low = fp.bitwiseAND(F.lit((1 << 16 * block) - 1)) if block else F.lit(0).cast("long")
        high = F.shiftrightunsigned(fp, 16 * block + 16) if block < 3 else F.lit(0).cast("long")
        rest = F.shiftleft(high, 16 * block).bitwiseOR(low)
        for part in range(4):
            tail = F.shiftrightunsigned(rest, 12 * part).bitwiseAND(F.lit(0xFFF))
            table = F.lit((4 * block + part) << 28).cast("long")
            keys.append(table.bitwiseOR(F.shiftleft(head, 12)).bitwiseOR(tail))
    return F.array(*keys)


def shared_bits(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mask of the bits all values of a slice share, and those bits."""
    every = np.bitwise_and.reduceat(values, starts)
    some = np.bitwise_or.reduceat(values, starts)
    mask = ~(every ^ some)
    return mask, every & mask


def _children(pairs: tuple[np.ndarray, np.ndarray], counts: int) -> tuple[np.ndarray, np.ndarray]:
    a, b = pairs
    i, j = np.divmod(np.arange(FAN * FAN), FAN)
    a = (a[:, None] * FAN + i).ravel()
    b = (b[:, None] * FAN + j).ravel()
    keep = (a < counts) & (b < counts) & (a <= b)
    return a[keep], b[keep]


def link_run(values: np.ndarray, labels: np.ndarray, first: int, radius: int,
             split: int = 0) -> None:
    """Merge, in `labels[first:]`, the values of one Gray-ordered run that
    differ in at most `radius` bits, by descending the index against itself.

    With `split`, only pairs across that position count: two blocks compared.
    """
    n = len(values)
    levels = []
    starts = np.arange(0, n, LEAF)
    while True:
        levels.append(shared_bits(values, starts))
        if len(starts) == 1:
            break
        starts = starts[::FAN]
    a = b = np.zeros(1, dtype=np.int64)
    for depth in range(len(levels) - 1, -1, -1):
        mask, pattern = levels[depth]
        if depth < len(levels) - 1:
            a, b = _children((a, b), len(mask))
        differ = popcount((pattern[a] ^ pattern[b]) & mask[a] & mask[b])
        near = differ <= radius
        if split:
            width = LEAF * FAN ** depth
            near &= (a * width < split) & ((b + 1) * width > split)
        a, b = a[near], b[near]
    i, j = np.divmod(np.arange(LEAF * LEAF), LEAF)
    for at in range(0, len(a), 1024):
        p = (a[at:at + 1024, None] * LEAF + i).ravel()
        q = (b[at:at + 1024, None] * LEAF + j).ravel()
        keep = (p < q) & (q < n)
        if split:
            keep &= (p < split) & (q >= split)
        p, q = p[keep], q[keep]
        near = popcount(values[p] ^ values[q]) <= radius
        resolve_pairs(labels, p[near] + first, q[near] + first)


def _forest(values: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inner = np.flatnonzero(labels != np.arange(len(labels)))
    return values[inner], values[labels[inner]]


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()),
                    ("mask", pa.int64()), ("pattern", pa.int64()), ("block", pa.binary())])
_LINKS_DDL = "a long, b long, key long, mask long, pattern long, block binary"


def _links(a, b) -> pa.RecordBatch:
    n = len(a)
    none = [pa.nulls(n, f.type) for f in _LINKS][2:]
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), *none],
                                      schema=_LINKS)


def _blocks(key: int, values: np.ndarray) -> pa.RecordBatch:
    starts = np.arange(0, len(values), BLOCK)
    mask, pattern = shared_bits(values, starts)
    n = len(starts)
    return pa.RecordBatch.from_arrays([
        pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array([key] * n, pa.int64()),
        pa.array(mask.view(np.int64)), pa.array(pattern.view(np.int64)),
        pa.array([values[s:s + BLOCK].tobytes() for s in starts], pa.binary())], schema=_LINKS)


def _link_batch(keys: np.ndarray, values: np.ndarray, radius: int) -> pa.RecordBatch:
    """Links within the complete runs of equal keys."""
    labels = np.arange(len(values))
    for step in range(1, LEAF):     # runs that fit one leaf: neighbours up to its width
        p = np.flatnonzero(keys[step:] == keys[:-step]) if step < len(keys) else np.zeros(0, int)
        if not len(p):
            break
        near = popcount(values[p] ^ values[p + step]) <= radius
        resolve_pairs(labels, p[near], p[near] + step)
    edges = np.flatnonzero(np.diff(keys)) + 1
    starts = np.concatenate(([0], edges))
    ends = np.concatenate((edges, [len(keys)]))
    for s, e in zip(starts, ends):
        if e - s > LEAF:
            link_run(values[s:e], labels, s, radius)
    return _links(*_forest(values, labels))


def _link_partition(radius: int):
    """Links of one range of (key, Gray rank); its first and last run, which may
    go on in another range, also leave as blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_v, leading = [], [], True
        for batch in batches:
            if not batch.num_rows:
                continue
            held_k.append(batch.column(0).to_numpy())
            held_v.append(batch.column(1).to_numpy().view(np.uint64))
            if held_k[-1][-1] == held_k[0][0]:
                continue            # one run so far: it may go on
            keys, values = np.concatenate(held_k), np.concatenate(held_v)
            if leading:
                edge = int(np.searchsorted(keys, keys[0], side="right"))
                yield _blocks(int(keys[0]), values[:edge])
                leading = False
            cut = int(np.searchsorted(keys, keys[-1], side="left"))
            yield _link_batch(keys[:cut], values[:cut], radius)
            held_k, held_v = [keys[cut:]], [values[cut:]]
        if held_k:
            keys, values = np.concatenate(held_k), np.concatenate(held_v)
            yield _blocks(int(keys[-1]), values)
            yield _link_batch(keys, values, radius)
    return run


def _link_blocks(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1)):
                left, right = (np.frombuffer(v.as_py(), dtype=np.uint64) for v in (x, y))
                values = np.concatenate((left, right))
                labels = np.arange(len(values))
                link_run(values, labels, 0, radius, split=len(left))
                yield _links(*_forest(values, labels)).select(["a", "b"])
    return run


def near_links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): a spanning forest of the links among the distinct values `fp`."""
    if radius > 3:
        raise ValueError("the blocking is exact up to 3 differing bits")
    filed = nodes.select(F.explode(_keys(F.col("fp"))).alias("key"), "fp",
                         _gray_rank(F.col("fp")).alias("rank"))
    ranged = filed.repartitionByRange("key", "rank").sortWithinPartitions("key", "rank")
    found = materialize(
        ranged.select("key", "fp").mapInArrow(_link_partition(radius), _LINKS_DDL)
        .withColumn("task", F.spark_partition_id()), "links")
    blocks = found.filter(F.col("key").isNotNull()).select("key", "task", "mask", "pattern", "block")
    left, right = blocks.alias("x"), blocks.alias("y")
    fixed = F.col("x.pattern").bitwiseXOR(F.col("y.pattern")).bitwiseAND(F.col("x.mask")).bitwiseAND(
        F.col("y.mask"))
    across = left.join(right, (F.col("x.key") == F.col("y.key")) & (F.col("x.task") < F.col("y.task"))
                       & (F.bit_count(fixed) <= radius))
    across = across.select(F.col("x.block").alias("x"), F.col("y.block").alias("y")).mapInArrow(
        _link_blocks(radius), "a long, b long")
    return found.filter(F.col("a").isNotNull()).select("a", "b").union(across)


def near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id): the near-duplicate group of every row of
    `docs`, named by its smallest doc_id."""
    rows = materialize(fingerprints(docs, size), "fingerprints")
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    groups = connected_components(near_links(nodes, radius))
    named = (nodes.join(groups, nodes.fp == groups.node, "left")
             .select("fp", "least", F.coalesce("component", "fp").alias("root")))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(named.join(least, "root").select("fp", "component_id"), "groups")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def _row_ids(docs: DataFrame) -> DataFrame:
    """`docs` with `__row`, the hash of id and text, and `__id`, which orders the
    rows: those with a doc_id first, by it, then by the hash."""
    docs = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    return docs.withColumn("__id", F.struct(F.col("doc_id").isNull().alias("none"),
                                            "doc_id", F.col("__row").alias("row")))


def _least_rows(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """`docs` of `_row_ids` with the least row of each group of (doc_id,
    component_id), and all rows without a doc_id."""
    kept = groups.filter((F.col("doc_id") == F.col("component_id")) & ~F.col("doc_id.none"))
    kept = kept.select(F.col("doc_id.row").alias("__row")).distinct()
    one = docs.join(kept, "__row").filter(F.col("doc_id").isNotNull()).dropDuplicates(["__row"])
    names = [c for c in docs.columns if c not in ("__row", "__id")]
    return one.select(*names).union(docs.filter(F.col("doc_id").isNull()).select(*names))


def keep_one(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """`docs` with one row of each near-duplicate group: that of its smallest
    doc_id.  Rows of one doc_id with different texts are rows of their own; equal
    ones fold.  Rows without a doc_id have no order and all stay."""
    docs = _row_ids(docs)
    groups = near_duplicates(docs.select(F.col("__id").alias("doc_id"), "text"), size, radius)
    return _least_rows(docs, groups)
