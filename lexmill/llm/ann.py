"""Approximate nearest neighbours: one navigable small-world hierarchy a shard.

Equal vectors fold to one node first, so a third of all rows being one vector is
one node.  A node is named by its smallest id and a hash of its vector, as one id
may stand with several vectors.  Nodes are dealt to shards by a hash of their
name.  Each shard's hierarchy is built in one task and stored as flat arrays:
every layer is one matrix of neighbour positions, row i for node i, and nodes are
numbered so that each layer holds a prefix of them.  Every query visits all
shards: a task reads the index of a shard once and the queries stream past it, a
batch in memory at a time.  The shard results are merged.

The number of shards is SHARDS at least, and grows where a shard would exceed
SHARD_VALUES numbers (components and links), which bounds the memory of a task
whatever the length of the vectors.

Largest inner product is turned into a nearest-neighbour search by one more
component that brings all nodes of a shard to equal length; queries have zero
there.  Reported scores are inner products of the original vectors in double
precision, summed in order of the components.

Cases: vectors that are null, empty, zero, or hold a null or non-finite component
take no part; only vectors of equal length meet; fewer than k candidates give all
of them; equal scores go to the smaller id; repeated rows of one id and vector
count once; an id with several vectors is one row for each of them: each is a
query with a list of its own (told apart by `query_key`, a hash of the vector),
each is a candidate, and a query leaves out only the row it is; a row without an
id takes no part; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from lexmill.llm.shared import materialize

K = 20
SHARDS = 12
SHARD_VALUES = 32_000_000
LINKS = 16                  # neighbours of a node; twice as many on the bottom layer
BUILD_WIDTH = 80            # candidates held while a node is placed
SEARCH_WIDTH = 160          # candidates held while a query is answered
STEP = 4                    # candidates opened at a time
_BATCH = 256
_PER_NODE = 3 * LINKS + 16  # numbers a node holds beside its components


def _expand(x: np.ndarray, links: np.ndarray, q: np.ndarray, start: np.ndarray, width: int):
    """Best `width` nodes for each query by a beam over one layer.

    `start` holds node positions, -1 for none.  Returns positions and scores,
    best first; free places have position -1 and score -inf.
    """
    n, rows = len(q), np.arange(len(q))[:, None]
    seen = np.zeros((n, len(x) + 1), dtype=bool)        # last column: position -1
    seen[:, -1] = True
    beam = np.full((n, width), -1, dtype=np.int32)
    score = np.full((n, width), -np.inf, dtype=np.float32)
    beam[:, :start.shape[1]] = start
    score[:, :start.shape[1]] = np.where(start >= 0, np.einsum("bkd,bd->bk", x[start], q), -np.inf)
    seen[rows, start] = True
    opened = beam < 0
    while True:
        live = np.flatnonzero(~opened.all(axis=1))
        if not len(live):
            break
        b, s, o = beam[live], score[live], opened[live]
        pick = np.argsort(np.where(o, np.inf, -s), axis=1, kind="stable")[:, :STEP]
        at = np.arange(len(live))[:, None]
        sources = np.where(o[at, pick], -1, b[at, pick])
        o[at, pick] = True
        near = np.where(sources[:, :, None] >= 0, links[sources], -1).reshape(len(live), -1)
        near.sort(axis=1)
        fresh = ~seen[live[:, None], near]
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        seen[live[:, None], near] = True
        seen[:, -1] = True
        room = int(fresh.sum(axis=1).max())
        if room:
            order = np.argsort(~fresh, axis=1, kind="stable")[:, :room]
            near = np.where(fresh[at, order], near[at, order], -1)
            gain = np.where(near >= 0, np.einsum("bkd,bd->bk", x[near], q[live]), -np.inf)
            b = np.concatenate((b, near), axis=1)
            s = np.concatenate((s, gain.astype(np.float32)), axis=1)
            o = np.concatenate((o, near < 0), axis=1)
            top = np.argsort(-s, axis=1, kind="stable")[:, :width]
            b, s, o = b[at, top], s[at, top], o[at, top]
        beam[live], score[live], opened[live] = b, s, o
    order = np.argsort(-score, axis=1, kind="stable")
    return beam[rows, order], score[rows, order]


def _spread(x: np.ndarray, near: np.ndarray, score: np.ndarray, links: int) -> np.ndarray:
    """Choose up to `links` of the candidates (best first): one that is closer to
    a chosen one than to the node waits, and fills a place left at the end."""
    n, width = near.shape
    vectors = x[near]
    between = np.matmul(vectors, vectors.transpose(0, 2, 1))
    chosen = np.zeros((n, width), dtype=bool)
    for c in range(width):
        blocked = (chosen & (between[:, :, c] > score[:, c:c + 1])).any(axis=1)
        chosen[:, c] = ~blocked & (near[:, c] >= 0) & (chosen.sum(axis=1) < links)
    order = np.argsort(np.where(near < 0, 2, ~chosen), axis=1, kind="stable")[:, :links]
    return np.take_along_axis(near, order, axis=1)


def _link_back(x: np.ndarray, table: np.ndarray, new: np.ndarray, near: np.ndarray) -> None:
    """Enter new nodes with their neighbours; a full neighbour keeps the closest."""
    links = table.shape[1]
    target, source = near.ravel(), np.repeat(new, near.shape[1])
    kept = target >= 0
    order = np.argsort(target[kept], kind="stable")
    target, source = target[kept][order], source[kept][order]
    heads = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1])))
    counts = np.diff(np.concatenate((heads, [len(target)])))
    place = np.arange(len(target)) - np.repeat(heads, counts)
    owner = target[heads]
    for low in range(0, len(owner), 4096):              # bounds the padded matrices
        part = slice(low, low + 4096)
        own, size = owner[part], counts[part]
        wide = np.full((len(own), links + int(size.max())), -1, dtype=np.int32)
        wide[:, :links] = table[own]
        rows = np.repeat(np.arange(len(own)), size)
        span = slice(heads[part][0], heads[part][-1] + size[-1])
        wide[rows, links + place[span]] = source[span]
        s = np.where(wide >= 0, np.einsum("bkd,bd->bk", x[wide], x[own]), -np.inf)
        order = np.argsort(-s, axis=1, kind="stable")[:, :links]
        table[own] = np.take_along_axis(wide, order, axis=1)


def _layer_sizes(n: int) -> list[int]:
    """Nodes of each layer, bottom first: each layer has a LINKS-th of the one below."""
    sizes = [n]
    while sizes[-1] > LINKS:
        sizes.append(-(-sizes[-1] // LINKS))
    return sizes


def build(x: np.ndarray) -> list[np.ndarray]:
    """Neighbour matrices of the layers, bottom first, for nodes in random order.

    Layers are filled from the top; within a layer nodes enter in batches that
    grow with what is already placed, and also see the rest of their batch.
    """
    upper: list[np.ndarray] = []
    for depth, size in reversed(list(enumerate(_layer_sizes(len(x))))):
        links = LINKS * (2 if depth == 0 else 1)
        table = np.full((size, links), -1, dtype=np.int32)
        done = 1
        while done < size:
            new = np.arange(done, min(size, done + max(1, min(done // 2, _BATCH))))
            q = x[new]
            start = np.zeros((len(new), 1), dtype=np.int32)
            for layer in upper:
                # the best on the layer above among the nodes already placed here
                usable = layer[:min(done, len(layer))]
                start = _expand(x[:len(usable)], np.where(usable < len(usable), usable, -1), q, start, 4)[0][:, :1]
            near, score = _expand(x[:done], table[:done], q, start, BUILD_WIDTH)
            among = q @ q.T
            np.fill_diagonal(among, -np.inf)
            mates = np.argsort(-among, axis=1, kind="stable")[:, :links]
            mate_score = np.take_along_axis(among, mates, axis=1)
            near = np.concatenate((near, np.where(np.isfinite(mate_score), new[mates], -1)), axis=1)
            score = np.concatenate((score, mate_score), axis=1)
            order = np.argsort(-score, axis=1, kind="stable")[:, :BUILD_WIDTH]
            near, score = np.take_along_axis(near, order, 1), np.take_along_axis(score, order, 1)
            near = _spread(x, near.astype(np.int32), score, links // 2 if depth == 0 else links)
            table[new, :near.shape[1]] = near
            _link_back(x, table, new.astype(np.int32), near)
            done = int(new[-1]) + 1
        upper.append(table)
    return upper[::-1]


def search(x: np.ndarray, layers: list[np.ndarray], q: np.ndarray, width: int) -> np.ndarray:
    """Positions of the best nodes found, best first, -1 where there are fewer."""
    start = np.zeros((len(q), 1), dtype=np.int32)
    for table in layers[:0:-1]:
        start = _expand(x[:len(table)], table, q, start, 4)[0][:, :1]
    return _expand(x, layers[0], q, start, width)[0]


def _level(vectors: np.ndarray) -> np.ndarray:
    """Vectors brought to one length by one more component."""
    squares = (vectors.astype(np.float64) ** 2).sum(axis=1)
    more = np.sqrt(np.maximum(squares.max() - squares, 0.0))
    return np.concatenate((vectors, more[:, None]), axis=1).astype(np.float32)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


_INDEX = ("dim int, shard int, kind string, ids binary, parts binary, vectors binary, "
          "widths array<int>, links array<binary>")
_FOUND = "query long, query_key long, node long, part long, score double"


def _build_shard(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    ids, parts = (rows.column(c).to_numpy().astype(np.int64) for c in ("node", "part"))
    mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ parts.astype(np.uint64)
    order = np.lexsort((parts, ids, mixed))
    ids, parts, vectors = ids[order], parts[order], _matrix(rows.column("vector").combine_chunks())[order]
    layers = build(_level(vectors))
    return pa.table({
        "dim": pa.array([key[0].as_py()], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32()),
        "kind": [vectors.dtype.str], "ids": pa.array([ids.tobytes()], pa.binary()),
        "parts": pa.array([parts.tobytes()], pa.binary()),
        "vectors": pa.array([vectors.tobytes()], pa.binary()),
        "widths": pa.array([[t.shape[1] for t in layers]], pa.list_(pa.int32())),
        "links": pa.array([[t.tobytes() for t in layers]], pa.list_(pa.binary()))})


def exact_scores(vectors: np.ndarray, near: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in double precision, components added in order."""
    total = np.zeros(near.shape, dtype=np.float64)
    for d in range(q.shape[1]):
        total += vectors[near, d].astype(np.float64) * q[:, d:d + 1].astype(np.float64)
    return total


class _Shard:
    """The index of one shard, opened from its stored row."""

    def __init__(self, row: dict):
        self.ids, self.parts = (np.frombuffer(row[c], dtype=np.int64) for c in ("ids", "parts"))
        self.vectors = np.frombuffer(row["vectors"], dtype=row["kind"]).reshape(len(self.ids), -1)
        self.layers = [np.frombuffer(b, dtype=np.int32).reshape(-1, w) for b, w in zip(row["links"], row["widths"])]
        self.levelled = _level(self.vectors)

    def answer(self, queries: pa.RecordBatch, k: int, width: int) -> pa.RecordBatch:
        """The k best nodes found for each query; equal scores by id."""
        q = _matrix(queries.column("vector"))
        flat = np.concatenate((q, np.zeros((len(q), 1))), axis=1).astype(np.float32)
        near = search(self.levelled, self.layers, flat, width)
        score = np.where(near >= 0, exact_scores(self.vectors, near, q), -np.inf)
        order = np.lexsort((self.parts[near], self.ids[near], -score), axis=1)[:, :k]
        score, near = np.take_along_axis(score, order, 1), np.take_along_axis(near, order, 1)
        kept = np.isfinite(score)
        name = lambda c: np.repeat(queries.column(c).to_numpy(), kept.sum(axis=1))
        return pa.RecordBatch.from_pydict({
            "query": name("node"), "query_key": name("part"), "node": self.ids[near[kept]],
            "part": self.parts[near[kept]], "score": score[kept]})


def _search_shards(k: int, width: int):
    """Rows come sorted by shard, the index of a shard before its queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard = None, None
        for batch in batches:
            dims, shards = batch.column("dim").to_numpy(), batch.column("shard").to_numpy()
            stored = batch.column("ids").is_valid().to_numpy(zero_copy_only=False)
            new = (dims[1:] != dims[:-1]) | (shards[1:] != shards[:-1]) | (stored[1:] != stored[:-1])
            edges = [0, *(np.flatnonzero(new) + 1), len(dims)]
            for low, high in zip(edges, edges[1:]):
                if low == high:
                    continue
                if stored[low]:
                    at, shard = (dims[low], shards[low]), _Shard(batch.slice(low, 1).to_pylist()[0])
                elif at == (dims[low], shards[low]):
                    for start in range(low, high, _BATCH):
                        yield shard.answer(batch.slice(start, min(_BATCH, high - start)), k, width)
    return run


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector): rows that take part."""
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad
        & F.exists("embedding", lambda v: v != 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector")).distinct()


def fold(rows: DataFrame, members: int) -> DataFrame:
    """(node, part, vector, members): distinct vectors, named by their smallest id
    and a hash, with their `members` smallest ids, all that a list of that length
    can show."""
    ranked = rows.withColumn("r", F.row_number().over(W.partitionBy("vector").orderBy("vec_id")))
    return (ranked.filter(F.col("r") <= members).groupBy("vector")
            .agg(F.min("vec_id").alias("node"), F.array_sort(F.collect_list("vec_id")).alias("members"))
            .withColumn("part", F.xxhash64("vector")))


def build_index(nodes: DataFrame, shards: int) -> DataFrame:
    """(dim, shard, …): one row of flat arrays for each shard."""
    dealt = nodes.select("node", "part", "vector", F.size("vector").alias("dim"),
                         F.pmod(F.xxhash64("node", "part"), F.lit(shards)).cast("int").alias("shard"))
    dealt = dealt.repartition(2 * shards, "dim", "shard")
    return dealt.groupBy("dim", "shard").applyInArrow(_build_shard, _INDEX)


def nearest(vectors: DataFrame, k: int = K, every: int = 20, width: int = SEARCH_WIDTH,
            shards: int = SHARDS, shard_values: int = SHARD_VALUES) -> DataFrame:
    """(query_id, rank, vec_id, score, query_key): the k nearest found for each row
    whose vec_id is divisible by `every`, the row itself left out."""
    rows = usable(vectors)
    nodes = materialize(fold(rows, k + 1), "nodes")
    values = nodes.agg(F.sum(F.size("vector").cast("long") + _PER_NODE)).first()[0] or 0
    shards = max(shards, -(-values // shard_values))
    index = materialize(build_index(nodes, shards), "index")

    asked = rows.filter(F.col("vec_id") % every == 0)
    asked = asked.join(nodes.select("vector", "node", "part"), "vector").select(
        F.col("vec_id").alias("query_id"), "node", "part", "vector", F.size("vector").alias("dim"))
    asked = materialize(asked, "queries")
    distinct = asked.groupBy("node", "part", "dim").agg(F.first("vector").alias("vector"))
    sent = distinct.select("node", "part", "vector", "dim", F.explode(
        F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    keys = ["dim", "shard"]
    met = (index.unionByName(sent, allowMissingColumns=True).repartition(2 * shards, *keys)
           .sortWithinPartitions(*keys, F.col("ids").isNull()))
    found = met.mapInArrow(_search_shards(k + 1, width), _FOUND)

    query = ["query", "query_key"]
    best = W.partitionBy(*query).orderBy(F.desc("score"), "node", "part")
    top = materialize(found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1)
                      .drop("r"), "found")
    shown = top.join(nodes.select("node", "part", "members"), ["node", "part"]).select(
        *query, "node", "part", "score", F.explode("members").alias("vec_id"))
    best = W.partitionBy(*query).orderBy(F.desc("score"), "vec_id")
    shown = shown.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1)
    paired = asked.select("query_id", F.col("node").alias("query"), F.col("part").alias("query_key")).join(shown, query)
    own = ((F.col("vec_id") == F.col("query_id")) & (F.col("node") == F.col("query"))
           & (F.col("part") == F.col("query_key")))
    final = W.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return (paired.filter(~own)
            .withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score", "query_key"))
