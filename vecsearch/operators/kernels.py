"""Arrow/NumPy helpers that run inside Spark tasks on one Arrow batch at a time.

Nothing here decides how work is spread: Spark partitions and shuffles the rows, these
functions only score the block they are handed and keep the best ``n`` per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Largest score matrix (query rows x base rows) held at once inside a task.
BLOCK_CELLS = 2_000_000
# Largest number of surviving pairs whose distance is recomputed in one go.
PAIR_CHUNK = 200_000
# Squared distances up to here fit 4-byte floats with room to spare.
SAFE_SQUARE = 1e37


def matrix(column) -> np.ndarray:
    """Arrow list column -> matrix (4- or 8-byte floats); every list must have the same length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    if rows == 0:
        return np.zeros((0, 0))
    if column.null_count:
        raise ValueError("vector column contains nulls")
    flat = column.flatten()
    if flat.null_count or len(flat) % rows:
        raise ValueError("vectors must have one common length and no null elements")
    lengths = np.diff(column.offsets.to_numpy())
    if lengths.size and lengths.min() != lengths.max():
        raise ValueError("vectors must have one common length")
    values = flat.to_numpy(zero_copy_only=False)
    if values.dtype.kind == "f" and not np.isfinite(values).all():
        raise ValueError("vectors must have finite elements only")
    if values.dtype != np.float32:
        values = values.astype(np.float64, copy=False)
    return values.reshape(rows, -1)


def id_values(column) -> np.ndarray:
    """Arrow id column -> NumPy array whose sort order equals Spark's."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_integer(column.type):
        return column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return np.array(column.to_pylist(), dtype=str)


def key_groups(keys) -> Iterator[tuple]:
    """(key, row numbers) for every distinct key of a batch of key lists."""
    per_row = np.diff(keys.offsets.to_numpy())
    owner = np.repeat(np.arange(len(per_row)), per_row)
    coded = keys.flatten().dictionary_encode()
    codes = coded.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    cuts = np.searchsorted(codes[order], np.arange(len(coded.dictionary) + 1))
    for i, key in enumerate(coded.dictionary.to_pylist()):
        yield key, owner[order[cuts[i]:cuts[i + 1]]]


def without_spare_copies(rows: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Positions to score: of equal rows only those with the ``n`` lowest ids.

    Equal rows are equally far from every query and ties go to the lower id, so no other copy can
    be among the ``n`` nearest. Without this, copies of one vector would all tie at the cut.
    """
    if len(rows) <= n:
        return np.arange(len(rows))
    mark = rows @ np.random.default_rng(0).normal(size=rows.shape[1])
    order = np.lexsort((ids, mark))
    close = mark[order[1:]] == mark[order[:-1]]
    if close.sum() < n:
        return np.arange(len(rows))
    equal = np.zeros(len(rows), dtype=bool)
    spots = np.nonzero(close)[0]
    equal[spots + 1] = (rows[order[spots + 1]] == rows[order[spots]]).all(axis=1)
    starts = np.maximum.accumulate(np.where(equal, 0, np.arange(len(rows))))
    return np.sort(order[np.arange(len(rows)) - starts < n])


def exact_sq(queries: np.ndarray, base: np.ndarray, q: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distance of the listed (query row, base row) pairs, from differences."""
    out = np.empty(len(q))
    step = max(1, min(PAIR_CHUNK, BLOCK_CELLS // max(1, base.shape[1])))
    for lo in range(0, len(q), step):
        diff = base[b[lo:lo + step]].astype(np.float64) - queries[q[lo:lo + step]]
        out[lo:lo + step] = np.einsum("ij,ij->i", diff, diff)
    return out


def _true_places(keep: np.ndarray) -> np.ndarray:
    """Flat positions of what is true, rising; eight cells are looked at in one go, as few hold anything."""
    flat = keep.reshape(-1)
    whole = len(flat) // 8 * 8
    words = np.flatnonzero(flat[:whole].view(np.uint64))
    word, place = np.nonzero(flat[:whole].reshape(-1, 8)[words])
    return np.concatenate([words[word] * 8 + place, whole + np.flatnonzero(flat[whole:])])


def _best_columns(scores: np.ndarray, n: int | None, bound, spread=None, visible=None) -> tuple[np.ndarray, np.ndarray]:
    """Positions that can still be among the ``n`` smallest of their row.

    ``scores`` are lower bounds of the true values, at most ``spread(rows)`` below them. Only what
    ``visible`` excludes is left out; a value beyond the number range counts as very far, not as missing.
    """
    if visible is not None:
        scores[~visible] = np.inf
    limit = np.asarray(bound, dtype=np.float64).astype(scores.dtype)
    # Rounding the limit must not push a tie out.
    limit = np.nextafter(limit, np.array(np.inf, dtype=scores.dtype))
    keep = scores <= limit[:, None]
    if visible is not None:
        keep &= visible
    width = max(1, scores.shape[1])
    at = _true_places(keep)
    q = at // width
    if n is not None and width > n and len(at) > 4 * n:
        # The bound of earlier blocks usually leaves few; select only where it does not.
        crowded = np.nonzero(np.bincount(q, minlength=len(scores)) > 4 * n)[0]
        if len(crowded):
            part = scores[crowded]
            upper = part if spread is None else part + spread(crowded)
            upper[np.isnan(upper)] = np.inf
            keep[crowded] &= part <= np.partition(upper, n - 1, axis=1)[:, n - 1:n]
            at = _true_places(keep)
            q = at // width
    return q, at - q * width


class FlatScorer:
    """Exact Euclidean scoring: a 4-byte matrix product selects, 8-byte differences decide.

    Blocks whose squared distances would leave the range of 4-byte floats are scored in 8 bytes; beyond
    that range too, every row is a candidate.
    """

    def pairs(self, key, queries, base, n, bound, visible=None):
        """-> (query row, base row, squared distance) of the pairs worth keeping."""
        if queries.shape[1] != base.shape[1]:
            raise ValueError("queries and base vectors must have one common length")
        found = []
        # Distances do not change when both sides move; small norms keep the product accurate.
        shift = queries.mean(axis=0)
        reach = max(np.abs(queries - shift).max(initial=0), np.abs(base - shift).max(initial=0))
        kind = np.float32 if reach ** 2 * 4 * (queries.shape[1] + 1) < SAFE_SQUARE else np.float64
        near_q = (queries - shift).astype(kind)
        # Twice what a sum of so many terms and the norms in it can be off.
        margin = (2 * queries.shape[1] + 16) * np.finfo(kind).eps
        q_norm = np.einsum("ij,ij->i", near_q, near_q)
        # One product gives the squared distance but for the query's own norm, which is taken off the bound instead.
        wide = len(base) > queries.shape[1]  # behind small keys there are fewer scores than elements of the queries
        left = np.concatenate([near_q * -2, np.ones((len(near_q), 1), dtype=kind)], axis=1) if wide else near_q
        with np.errstate(invalid="ignore"):
            limit = np.where(np.isfinite(q_norm), np.asarray(bound, dtype=np.float64) - q_norm.astype(np.float64) * (1 - margin), np.inf)
        step = max(1, BLOCK_CELLS // max(1, len(queries)))
        for lo in range(0, len(base), step):
            part = base[lo:lo + step]
            near_b = (part - shift).astype(kind)
            b_norm = np.einsum("ij,ij->i", near_b, near_b)
            low = (b_norm * (1 - margin)).astype(kind)
            if wide:
                scores = left @ np.concatenate([near_b, low[:, None]], axis=1).T
            else:
                scores = left @ near_b.T
                scores *= -2
                scores += low[None, :]
            if kind is np.float64:
                scores[np.isnan(scores)] = -np.inf

            def spread(rows, b_norm=b_norm):
                return (2 * margin * (q_norm[rows, None] + b_norm[None, :])).astype(kind)

            seen = None if visible is None else visible[:, lo:lo + step]
            q, b = _best_columns(scores, n, limit, spread, seen)
            found.append((q, b + lo, exact_sq(queries, part, q, b)))
        if len(found) == 1:
            return found[0]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class AdcScorer:
    """Table-lookup scoring of product-quantised rows (codes instead of vectors)."""

    def __init__(self, shared):
        # Broadcast of ({cell key: centroid}, codebook array (m, codes, sub_dim)); without
        # centroids the queries are residuals already.
        self.shared = shared

    def pairs(self, key, queries, base, n, bound, visible=None):
        centroids, codebook = self.shared.value
        m, n_codes, sub = codebook.shape
        residual = queries if centroids is None else queries - centroids[key]
        codes = base.astype(np.int64)
        found = []
        q_step = max(1, BLOCK_CELLS // (m * n_codes * sub))
        for qlo in range(0, len(residual), q_step):
            split = residual[qlo:qlo + q_step].reshape(-1, m, 1, sub)
            table = ((split - codebook[None]) ** 2).sum(axis=3)
            step = max(1, BLOCK_CELLS // max(1, len(table)))
            for lo in range(0, len(codes), step):
                part = codes[lo:lo + step]
                scores = table[:, 0, part[:, 0]]
                for j in range(1, m):
                    scores = scores + table[:, j, part[:, j]]
                seen = None if visible is None else visible[qlo:qlo + q_step, lo:lo + step]
                q, b = _best_columns(scores, n, bound[qlo:qlo + q_step], None, seen)
                found.append((q + qlo, b + lo, scores[q, b]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class BestN:
    """The ``n`` best (squared distance, id) seen so far for every query row of a task."""

    def __init__(self, n_queries: int, n: int | None, dedupe: bool = False):
        self.n, self.dedupe, self.n_queries = n, dedupe, n_queries
        self.q = np.zeros(0, dtype=np.int64)
        self.d2 = np.zeros(0)
        self.ids: np.ndarray | None = None
        self.bound = np.full(n_queries, np.inf)

    def add(self, q, d2, ids) -> None:
        if len(q) == 0:
            return
        if self.ids is not None:
            q = np.concatenate([self.q, q])
            d2 = np.concatenate([self.d2, d2])
            ids = np.concatenate([self.ids, ids])
        if self.dedupe:
            order = np.lexsort((d2, ids, q))
            q, d2, ids = q[order], d2[order], ids[order]
            fresh = np.ones(len(q), dtype=bool)
            fresh[1:] = (q[1:] != q[:-1]) | (ids[1:] != ids[:-1])
            q, d2, ids = q[fresh], d2[fresh], ids[fresh]
        order = np.lexsort((ids, d2, q))
        q, d2, ids = q[order], d2[order], ids[order]
        if self.n is not None:
            place = np.arange(len(q)) - np.searchsorted(q, q, side="left")
            keep = place < self.n
            q, d2, ids, place = q[keep], d2[keep], ids[keep], place[keep]
            full = place == self.n - 1
            self.bound[q[full]] = d2[full]
        self.q, self.d2, self.ids = q, d2, ids


def nearest_rows(vectors: np.ndarray, centres: np.ndarray, labels: np.ndarray, n: int) -> np.ndarray:
    """Labels of the ``n`` nearest centres of each vector, nearest first, lowest label on ties."""
    n = min(n, len(centres))
    out = np.empty((len(vectors), n), dtype=labels.dtype)
    step = max(1, BLOCK_CELLS // max(1, len(centres)))
    scorer = FlatScorer()
    for lo in range(0, len(vectors), step):
        part = vectors[lo:lo + step]
        best = BestN(len(part), n)
        q, b, d2 = scorer.pairs(None, part, centres, n, best.bound)
        best.add(q, d2, labels[b])
        out[lo:lo + step] = best.ids.reshape(len(part), n)
    return out
