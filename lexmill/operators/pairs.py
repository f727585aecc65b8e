"""Best pairs of a block of queries and a block of vectors or documents, inside one task."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Executors need no installed copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Cells of one similarity matrix, and the room for the last bits of a product.
CELLS = 4_000_000
SLACK = 1e-9
# Terms of a part that are not read but bounded: so many, held by over this share of its documents.
COMMON, SHARE = 64, 0.2


def _matrix(column: pa.ChunkedArray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as rows, and which of them have `size` numbers; the others are zero."""
    lists = column.combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    whole = np.array([x is not None and x == size for x in lists.value_lengths().to_pylist()], dtype=bool)
    rows = np.zeros((len(lists), size))
    flat = lists.filter(pa.array(whole)).flatten()
    rows[whole] = flat.to_numpy(zero_copy_only=False).reshape(int(whole.sum()), size)
    if flat.null_count:
        holes = flat.is_null().to_numpy(zero_copy_only=False).reshape(int(whole.sum()), size).any(axis=1)
        whole[np.flatnonzero(whole)[holes]] = False
    return rows, whole


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed in the order of the dimensions."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total = total + a[:, j] * b[:, j]
    return total


def _lengths(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(float)


def _steps(n: int, width: int) -> Iterator[slice]:
    step = max(1, CELLS // max(1, width))
    return (slice(i, min(n, i + step)) for i in range(0, n, step))


def best_pairs(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """(term, tv, tl) against (neighbor, nv, nl) → (term, neighbor, similarity).

    Every pair is looked at; those that can be among the k best of their term stay,
    ties by the smaller neighbour, a missing similarity after all others.  A matrix
    product finds them, and their similarity is then summed dimension by dimension,
    as `dot` and `cosine` do.
    """
    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = sorted(set(right["neighbor"].to_pylist()))
        place = {x: i for i, x in enumerate(ids)}
        neighbor = np.array([place[x] for x in right["neighbor"].to_pylist()], dtype=np.int64)
        own = np.array([place.get(x, -1) for x in left["term"].to_pylist()], dtype=np.int64)
        sizes = {n for n in left["tv"].combine_chunks().value_lengths().to_pylist() if n is not None}
        found = []
        done = np.zeros(len(own), dtype=bool)
        for size in sorted(sizes):
            q, q_whole = _matrix(left["tv"], size)
            v, v_whole = _matrix(right["nv"], size)
            done |= q_whole
            found.append(_of_size(np.flatnonzero(q_whole), q, _lengths(left["tl"]), v, v_whole,
                                  _lengths(right["nl"]), own, neighbor, k))
        found.append(_without(np.flatnonzero(~done), np.arange(len(neighbor)), own, neighbor, k))
        term, other, value = (np.concatenate(x) for x in zip(*found))
        missing = np.isneginf(value)
        return pa.table({"term": left["term"].take(pa.array(term)),
                         "neighbor": right["neighbor"].take(pa.array(other)),
                         "similarity": pa.array(value, mask=missing)})
    return best


def _first(term, other, value, neighbor, k):
    """At most k pairs of a term and value, those with the smallest neighbours."""
    order = np.lexsort((neighbor[other], value, term))
    term, other, value = term[order], other[order], value[order]
    new = np.ones(len(term), dtype=bool)
    same = (value[1:] == value[:-1]) | (np.isnan(value[1:]) & np.isnan(value[:-1]))
    new[1:] = (term[1:] != term[:-1]) | ~same
    start = np.maximum.accumulate(np.where(new, np.arange(len(term)), 0))
    keep = np.arange(len(term)) - start < k
    return term[keep], other[keep], value[keep]


def _without(terms, others, own, neighbor, k):
    """Pairs without a similarity, marked by minus infinity."""
    least = others[np.argsort(neighbor[others], kind="stable")]
    # rows that may be the term itself come on top of the k wanted
    term, other = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for t in terms:
        mine = least if own[t] < 0 else least[neighbor[least] != own[t]]
        other.append(mine[:k])
        term.append(np.full(len(other[-1]), t))
    term, other = np.concatenate(term), np.concatenate(other)
    return term, other, np.full(len(term), -np.inf)


def _of_size(terms, q, ql, v, v_whole, vl, own, neighbor, k):
    """Pairs of the terms of one number of dimensions."""
    plain = v_whole & np.isfinite(v).all(axis=1) & np.isfinite(vl) & (vl > 1e-100) & (vl < 1e100)
    odd = np.flatnonzero(v_whole & ~plain)
    plain = np.flatnonzero(plain)
    missing = [np.flatnonzero(~v_whole)]
    usual = np.isfinite(q[terms]).all(axis=1) & np.isfinite(ql[terms]) & (ql[terms] > 1e-100) & (ql[terms] < 1e100)
    out = []

    def exact(t, o):
        with np.errstate(all="ignore"):
            both = ql[t] * vl[o]
            value = _products(q[t], v[o]) / both
        # in Spark, NaN is larger than zero
        value = np.where((both > 0) | np.isnan(both), value, -np.inf)
        out.append(_first(t, o, value, neighbor, k))

    if len(plain):
        unit = v[plain] / vl[plain][:, None]
        for part in _steps(int(usual.sum()), len(plain)):
            t = terms[usual][part]
            near = (q[t] / ql[t][:, None]) @ unit.T
            near[own[t][:, None] == neighbor[plain][None, :]] = -np.inf
            at = max(0, len(plain) - k)
            floor = np.partition(near, at, axis=1)[:, at] if len(plain) > k else np.full(len(t), -np.inf)
            i, j = np.nonzero((near >= floor[:, None] - SLACK) & (near > -np.inf))
            for some in _steps(len(i), 2 * q.shape[1]):
                exact(t[i[some]], plain[j[some]])
    # the rest, pair by pair: zero, not finite, or of extreme length
    for group, others in ((terms[usual], odd), (terms[~usual], np.concatenate((plain, odd)))):
        for part in _steps(len(group), len(others) * 2 * q.shape[1]):
            t, o = np.repeat(group[part], len(others)), np.tile(others, part.stop - part.start)
            other_id = own[t] != neighbor[o]
            exact(t[other_id], o[other_id])
    out.append(_without(terms, missing[0], own, neighbor, k))
    return tuple(np.concatenate(x) for x in zip(*out))


def nearest_pairs(k: int, exclude_self: bool, whole: bool = False) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Terms of queries (query_id, t, wt) against postings (doc_id, label, term, w) →
    (query_id, doc_id, label, score, first): the k nearest documents of each query, ties by
    the smaller doc_id; with `whole` every pair scored in full.

    The COMMON terms held by over a SHARE of the documents are kept as columns and bounded
    by lengths; the postings of the others are read.  Pairs scored to find the floor are `first`.
    """
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (len(left) and len(right)):
            return pa.table({"query_id": left["query_id"].slice(0, 0), "doc_id": right["doc_id"].slice(0, 0),
                             "label": right["label"].slice(0, 0), "score": np.zeros(0), "first": np.zeros(0, dtype=bool)})
        names, terms = pc.unique(left["query_id"]), pc.unique(left["t"])
        q, qt = (pc.index_in(left[c], value_set=x).to_numpy() for c, x in (("query_id", names), ("t", terms)))
        order = np.argsort(q, kind="stable")
        bounds, qt, wq = np.searchsorted(q[order], np.arange(len(names) + 1)), qt[order], left["wt"].to_numpy()[order]
        # a document is a doc_id with a label
        ids, labels = pc.unique(right["doc_id"]), pc.unique(right["label"])
        d, kind = (pc.index_in(right[c], value_set=x).to_numpy() for c, x in (("doc_id", ids), ("label", labels)))
        both = pa.array(d * np.int64(len(labels)) + kind)
        keys = pc.unique(both)
        d = pc.index_in(both, value_set=keys).to_numpy()
        ids, labels = (x.take(pa.array(at)) for x, at in zip((ids, labels), np.divmod(keys.to_numpy(), len(labels))))
        t, w = pc.index_in(right["term"], value_set=terms), right["w"].to_numpy()
        known = pc.is_valid(t).to_numpy()
        t, d, w = t.fill_null(-1).to_numpy()[known], d[known], w[known]
        del known, kind, both, q
        # postings by term, the rows of a document that hold the same term as one
        order = np.lexsort((d, t))
        t, d, w = t[order], d[order], w[order]
        del order
        pa.default_memory_pool().release_unused()
        if len(t):
            new = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (d[1:] != d[:-1])])
            t, d, w = t[new], d[new], np.add.reduceat(w, new)
        start = np.searchsorted(t, np.arange(len(terms) + 1))
        often = np.diff(start)
        common = np.argsort(-often, kind="stable")[:COMMON]
        common = common[often[common] > SHARE * len(ids)]
        column = np.full(len(terms), -1)
        column[common] = np.arange(len(common))
        cells = np.zeros((len(ids), len(common)))
        for c, x in enumerate(common):
            cells[d[start[x]:start[x + 1]], c] = w[start[x]:start[x + 1]]
        lengths = np.sqrt(np.einsum("ij,ij->i", cells, cells))
        place = np.empty(len(ids), dtype=np.int64)
        place[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
        own: dict = {}
        for i, x in enumerate(ids.to_pylist() if exclude_self else ()):
            own.setdefault(x, []).append(i)
        start, found = start.tolist(), ([], [], [], [])
        for i, name in enumerate(names.to_pylist()):
            mine, weight = qt[bounds[i]:bounds[i + 1]], wq[bounds[i]:bounds[i + 1]]
            unread = column[mine] >= 0
            across = np.bincount(column[mine[unread]], weight[unread], len(common))
            score = np.zeros(len(ids))
            for x, v in zip(mine[~unread].tolist(), weight[~unread].tolist()):
                a, b = start[x], start[x + 1]
                score[d[a:b]] += v * w[a:b]
            ceiling = score + np.sqrt(across @ across) * lengths
            if name in own:
                ceiling[own[name]] = 0.0
            at = np.flatnonzero(ceiling)
            top = at
            if len(at) > 2 * k:
                top = at[np.argpartition(ceiling[at], len(at) - 2 * k)[len(at) - 2 * k:]]
            value = score[top] + cells[top] @ across
            floor = np.partition(value, len(value) - k)[len(value) - k] if len(value) >= k else 0.0
            # room for the last bits of sums, and for ties by 12 digits
            ceiling[top] = -1.0
            rest = at[ceiling[at] >= floor * (1 - SLACK) - 2e-12]
            at = np.concatenate((top, rest))
            value = np.concatenate((value, score[rest] + cells[rest] @ across))
            best = np.flatnonzero(value > 0) if not whole else np.arange(len(at))
            if not whole and len(best) > k:
                best = best[np.lexsort((place[at[best]], -np.round(value[best], 12)))[:k]]
            for out, x in zip(found, (np.full(len(best), i), at[best], value[best], best < len(top))):
                out.append(x)
        i, at, value, first = (np.concatenate(x) for x in found)
        return pa.table({"query_id": names.take(pa.array(i)), "doc_id": ids.take(pa.array(at)),
                         "label": labels.take(pa.array(at)), "score": value, "first": first})
    return run
