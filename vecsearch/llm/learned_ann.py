"""Approximate nearest neighbours by learned partitions.

A neighbour graph of a bounded sample is cut into balanced parts; a small network learns, from the vector alone, in which
parts a vector's neighbours lie. Every row is indexed under its most probable part. A query is routed to the most probable
parts, as many as a held-out sample needs for the wanted recall, and all their rows are ranked by the exact inner product.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Stored
from .convnet import adam, softmax

BLOCK, BUNDLE = 4096, 16_384  # queries, and base rows, that one task holds at a time
SLICE = 256


@dataclass
class Router:
    """Two-layer network over parts; ``probes`` is the number of parts a query visits."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)
        return softmax(np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` rows of largest inner product of every row of a bounded sample."""
    k = min(k, len(x) - 1)
    out = np.zeros((len(x), k), np.int64)
    for at in range(0, len(x), 512):
        s = x[at:at + 512] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out[at:at + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rng: np.random.Generator, rounds: int = 12, slack: float = 1.1) -> np.ndarray:
    """Parts of nearly equal size that few edges of the graph cross.

    Starts from halvings at the median along main directions; then nodes move to the part most of their neighbours are in,
    largest gain first, while that part has room.
    """
    part = np.zeros(len(x), np.int64)
    stack = [(np.arange(len(x)), 0, parts)]
    while stack:
        rows, first, n = stack.pop()
        part[rows] = first
        if n == 1:
            continue
        centred = x[rows] - x[rows].mean(axis=0)
        direction = rng.normal(size=x.shape[1])
        for _ in range(5):
            direction = centred.T @ (centred @ direction)
            direction /= max(np.linalg.norm(direction), 1e-30)
        order = rows[np.argsort(centred @ direction, kind="stable")]
        left = n // 2
        cut = len(rows) * left // n
        stack += [(order[:cut], first, left), (order[cut:], first + left, n - left)]
    room = max(-(-len(x) // parts), int(slack * len(x) / parts))
    both = np.concatenate([np.stack([np.repeat(np.arange(len(x)), graph.shape[1]), graph.ravel()], 1)] * 2)
    both[len(both) // 2:] = both[len(both) // 2:, ::-1]
    for _ in range(rounds):
        near = np.zeros((len(x), parts), np.int32)
        np.add.at(near, (both[:, 0], part[both[:, 1]]), 1)
        best = near.argmax(axis=1)
        gain = near[np.arange(len(x)), best] - near[np.arange(len(x)), part]
        size = np.bincount(part, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable").tolist():
            if gain[i] <= 0:
                break
            if size[best[i]] < room:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


def train_router(x: np.ndarray, k: int, parts: int, recall: float, seed: int, hidden: int = 128, epochs: int = 15) -> Router:
    """Partitions the sample's graph, fits the network, and finds the number of probes on a held-out tenth."""
    rng = np.random.default_rng(seed)
    dim = x.shape[1]
    shape = lambda a, b: rng.normal(size=(a, b)) * (2 / a) ** 0.5
    router = Router(shape(dim, hidden), np.zeros(hidden), shape(hidden, parts), np.zeros(parts))
    if parts == 1:
        return router
    x = x[rng.permutation(len(x))]
    asked, x = x[:len(x) // 10], x[len(x) // 10:]
    graph = neighbour_graph(x, k)
    part = balanced_parts(x, graph, parts, rng)
    target = np.zeros((len(x), parts))  # the parts of a row's neighbours, and its own
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 0.5 / graph.shape[1])
    target[np.arange(len(x)), part] += 0.5
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    weights = [router.w1, router.b1, router.w2, router.b2]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in weights]
    t = 0
    for epoch in range(epochs):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
            t += 1
            h = np.maximum(unit[rows] @ router.w1 + router.b1, 0)
            d = (softmax(h @ router.w2 + router.b2) - target[rows]) / len(rows)
            dh = (d @ router.w2.T) * (h > 0)
            for p, g, m in zip(weights, (unit[rows].T @ dh, dh.sum(0), h.T @ d, d.sum(0)), moments):
                adam(p, g, *m, t, 0.003 * (1 - 0.9 * epoch / epochs))
    home = router.probabilities(x).argmax(axis=1)
    s = asked @ x.T
    true = np.argpartition(-s, min(k, len(x)) - 1, axis=1)[:, :k]
    order = np.argsort(-router.probabilities(asked), axis=1)
    place = np.argsort(order, axis=1)  # rank of each part for each query
    visited = np.take_along_axis(place, home[true], axis=1)
    share = [(visited < n).mean() for n in range(1, parts + 1)]
    router.probes = next((n for n, r in enumerate(share, 1) if r >= recall), parts)
    return router


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of equal length as rows of 8-byte floats."""
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and no null or non-finite component."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda v: v != 0)


def best_of(q: np.ndarray, q_ids: np.ndarray, b: np.ndarray, b_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, base id, score) of the ``k`` best base ids per query row; none is a candidate of its own id."""
    order = np.argsort(b_ids, kind="stable")
    starts = np.flatnonzero(np.append(True, np.diff(b_ids[order]) != 0))
    single = len(starts) == len(b_ids)
    out_q, out_b, out_s = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    # Two orders of the additions of a product differ by less than this times the query's length.
    slack = 2 * (b.shape[1] + 8) * np.finfo(np.float64).eps * np.linalg.norm(b, axis=1).max(initial=0)
    for at in range(0, len(q), SLICE):
        s = q[at:at + SLICE] @ b.T
        own = q_ids[at:at + SLICE]
        s[own[:, None] == b_ids[None]] = -np.inf
        each = s if single else np.maximum.reduceat(s[:, order], starts, axis=1)  # the best row of an id
        low = np.partition(each, len(starts) - k, axis=1)[:, len(starts) - k] if len(starts) > k else np.full(len(s), -np.inf)
        margin = slack * np.linalg.norm(q[at:at + SLICE], axis=1)
        for i in range(len(s)):
            may = np.flatnonzero((s[i] >= low[i] - margin[i]) & (s[i] > -np.inf))
            exact = (b[may] * q[at + i]).sum(axis=1)  # the same order of additions for every row: equal vectors tie
            if not single:
                best = np.lexsort((-exact, b_ids[may]))
                best = best[np.append(True, np.diff(b_ids[may[best]]) != 0)] if len(best) else best
                may, exact = may[best], exact[best]
            top = np.lexsort((b_ids[may], -exact))[:k]
            out_q.append(np.full(len(top), own[i])), out_b.append(b_ids[may[top]]), out_s.append(exact[top])
    return np.concatenate(out_q), np.concatenate(out_b), np.concatenate(out_s)


def best_in_parts(base: pa.Table, asked: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``best_of`` over the parts in ``base``, each query row only in the parts it visits, merged per query."""
    part, b, b_ids = base.column("part").to_numpy(), matrix(base.column("embedding")), base.column("vec_id").to_numpy()
    q, q_ids, visits = matrix(asked.column("embedding")), asked.column("vec_id").to_numpy(), asked.column("parts").combine_chunks()
    rows, to = np.repeat(np.arange(len(q)), np.diff(visits.offsets.to_numpy())), visits.flatten().to_numpy()
    found = []
    for p in np.unique(part).tolist():
        mine, who = part == p, rows[to == p]
        found.append(best_of(q[who], q_ids[who], b[mine], b_ids[mine], k))
    query, row, score = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((-score, row, query))  # the best row of an id that lies in several parts
    query, row, score = query[order], row[order], score[order]
    first = np.ones(len(query), bool)
    first[1:] = (query[1:] != query[:-1]) | (row[1:] != row[:-1])
    query, row, score = query[first], row[first], score[first]
    order = np.lexsort((row, -score, query))
    query, row, score = query[order], row[order], score[order]
    place = np.arange(len(query)) - np.searchsorted(query, query, side="left")
    return query[place < k], row[place < k], score[place < k]


def per_part(df: DataFrame, parts: int) -> np.ndarray:
    """Rows of every part (one number per part reaches the driver)."""
    out = np.zeros(parts, np.int64)
    for r in df.groupBy("part").count().collect():
        out[r["part"]] = r["count"]
    return out


def search(vectors: DataFrame, is_query: Column, k: int = 20, part_rows: int = 512, sample_rows: int = 8192, most_parts: int = 256,
           recall: float = 0.95, seed: int = 5) -> DataFrame:
    """The ``k`` nearest rows (largest inner product) found for every row of ``vectors`` (vec_id, embedding) that ``is_query`` marks.

    Returns query_id, rank (from 1), vec_id, score; nearest first, ties to the smaller vec_id. The router is fitted on at most
    ``sample_rows`` vectors (those of smallest hash); every row is indexed, and the number of probes is set for ``recall`` on held-out
    vectors. A part of any size is searched in blocks, so no task holds more than about ``BUNDLE`` rows and ``BLOCK`` queries. A query whose
    probed parts hold fewer than ``k`` others visits further parts until they do.

    Vectors null, empty, zero, or with null or non-finite components take no part, nor do those whose length isn't the commonest
    (ties: the smaller), nor rows without vec_id. Rows that share a vec_id are one candidate, and one query, of several vectors, for
    which the best product counts; no row is a candidate of its own id. Further columns are ignored; an empty table gives no row.
    """
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("embedding"), is_query.alias("asks"))
    plain = plain.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    lengths = plain.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not lengths:
        return vectors.sparkSession.createDataFrame([], schema)
    dim, n = lengths[0]["dim"], lengths[0]["count"]
    plain = plain.where(F.size("embedding") == dim)
    share = min(1.0, 1.2 * sample_rows / n)
    slot = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40))
    picked = plain.where(slot <= int(share * (1 << 40))).select("embedding").limit(sample_rows).toArrow()
    sample = np.unique(matrix(picked.column("embedding")), axis=0)
    parts = int(max(1, min(most_parts, n // part_rows, len(sample) // 32)))
    router = train_router(sample, k, parts, recall, seed)

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            home = router.probabilities(matrix(batch.column("embedding"))).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(home, pa.int32()), *batch.columns], ["part", *batch.schema.names])

    kind = dict(plain.dtypes)["embedding"]
    index = Stored(plain.mapInArrow(place, f"part int, vec_id long, embedding {kind}, asks boolean"), "ann_index")
    held = per_part(index.df, parts)
    # Distinct ids, each counted in one part only: so many others a set of parts holds at least.
    ids = per_part(index.df.groupBy("vec_id").agg(F.min("part").alias("part")), parts)

    def route(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            order = np.argsort(-router.probabilities(matrix(batch.column("embedding"))), axis=1, kind="stable")
            enough = (np.cumsum(ids[order], axis=1) < k + 1).sum(axis=1) + 1
            visits = np.minimum(np.maximum(enough, router.probes), parts)
            to = pa.array([o[:v] for o, v in zip(order.astype(np.int32), visits)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, to], [*batch.schema.names, "parts"])

    asked = index.df.where("asks").select("vec_id", "embedding").mapInArrow(route, f"vec_id long, embedding {kind}, parts array<int>")
    asked = Stored(asked, "ann_queries")
    wanted = per_part(asked.df.select(F.explode("parts").alias("part")), parts)
    # Small parts share a bundle, a large one is split into several; a task searches one bundle.
    blocks, start, filled = [], [], BUNDLE
    bundle = -1
    for rows in held.tolist():
        blocks.append(max(1, -(-rows // BUNDLE)))
        if blocks[-1] > 1 or filled + rows > BUNDLE:
            bundle, filled = bundle + 1, 0
        start.append(bundle)
        bundle += blocks[-1] - 1
        filled += rows
    turns = [1] * (bundle + 1)  # groups of queries per bundle
    for first, n_blocks, n_asked in zip(start, blocks, wanted.tolist()):
        for i in range(first, first + n_blocks):
            turns[i] = max(turns[i], -(-n_asked // BLOCK))
    of = lambda table, at: F.get(F.array(*[F.lit(int(v)) for v in table]), at)
    salt = lambda n: F.pmod(F.xxhash64("vec_id", "embedding"), n).cast("int")
    base = index.df.withColumn("bundle", of(start, F.col("part")) + salt(of(blocks, F.col("part"))))
    base = base.select("bundle", F.explode(F.sequence(F.lit(0), of(turns, F.col("bundle")) - 1)).alias("turn"), "part", "vec_id", "embedding")
    to = F.array_distinct(F.flatten(F.transform("parts", lambda p: F.sequence(of(start, p), of(start, p) + of(blocks, p) - 1))))
    ask = asked.df.select(F.explode(to).alias("bundle"), "vec_id", "embedding", "parts")
    ask = ask.select("bundle", salt(of(turns, F.col("bundle"))).alias("turn"), "vec_id", "embedding", "parts")
    key = ["bundle", "turn"]

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        found = best_in_parts(left, right, k) if left.num_rows and right.num_rows else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()), "score": pa.array(found[2], pa.float64())})

    found = base.groupBy(*key).cogroup(ask.groupBy(*key)).applyInArrow(rank, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
