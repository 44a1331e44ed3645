"""Inverted file: vectors grouped by nearest centroid, queries read the nearest cells."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.distance import l2
from ..functions.hashing import dimension
from .common import SMALL_CENTROID_ROWS, arrow_column, fetch_if_small, settle, top_n
from .exact import knn_exact
from .kernels import id_values, matrix, nearest_rows
from .keyed import search_keyed
from .lloyd import train


# Steps that place the roots over a centroid table too large to be shipped.
TREE_STEPS = 10


@dataclass(frozen=True)
class IvfParams:
    nlist: int = 100
    nprobe: int = 10
    seed: int = 42
    restarts: int = 10


def kmeans(base: DataFrame, k: int, seed: int = 42, restarts: int = 1, max_iter: int = 300,
           init: DataFrame | None = None) -> DataFrame:
    """Best of several seeded k-means runs, all advanced in one scan per step: cell, centroid.

    An empty cell starts again at the row farthest from its centroid, so none stays empty while there are rows apart.
    With ``init`` (cell, centroid) one run of at most ``max_iter`` steps from that start; it ends when nothing moves.
    """
    if init is not None:
        return _from_start(init, lambda c: lloyd_step(base, c), ["cell"], max_iter)
    best = train(base, [(0, dimension(base))], k, seed, restarts, max_iter)[0]
    rows = [(i, c) for i, c in enumerate(best.centres.tolist())]
    return base.sparkSession.createDataFrame(rows, "cell int, centroid array<double>")


def _from_start(start: DataFrame, step, keys: list[str], max_iter: int) -> DataFrame:
    """Repeat a training step until its centroids stay where they are."""
    current = start
    for _ in range(max_iter):
        moved = settle(step(current))
        before = current.select(*keys, F.col("centroid").cast("array<double>").alias("before"))
        still = moved.join(before, keys).where(~F.col("before").eqNullSafe(F.col("centroid"))).isEmpty()
        current = moved
        if still:
            break
    return current


def nearest_cells(df: DataFrame, id_col: str, vec_col: str, centroids: DataFrame, n: int) -> DataFrame:
    """The input with ``cells``: the ``n`` nearest cells, nearest first, lowest cell on ties.

    The centroid table is shipped to the tasks only after its size has been checked; a larger one is searched by a tree of two
    levels (see ``tree_cells``) with the same result.
    """
    table = fetch_if_small(centroids.select("cell", "centroid"), SMALL_CENTROID_ROWS)
    if table is None:
        asked = df.select(F.col(id_col).alias("query_id"), F.col(vec_col).alias("query_vec"))
        near = tree_cells(asked, centroids, n).groupBy(F.col("query_id").alias(id_col)).agg(
            F.transform(F.sort_array(F.collect_list(F.struct("rank", "neighbor_id"))),
                        lambda x: x["neighbor_id"]).alias("cells"))
        return df.join(near, id_col)
    labels = id_values(table["cell"]).astype(np.int32)
    order = np.argsort(labels)
    shared = df.sparkSession.sparkContext.broadcast((matrix(table["centroid"])[order], labels[order]))

    @arrow_column("array<int>")
    def cells(batch: pa.Array) -> pa.Array:
        if len(batch) == 0:
            return pa.array([], type=pa.list_(pa.int32()))
        centres, names = shared.value
        near = nearest_rows(matrix(batch), centres, names, n)
        offsets = pa.array(np.arange(len(near) + 1, dtype=np.int32) * near.shape[1])
        return pa.ListArray.from_arrays(offsets, pa.array(near.ravel()))

    return df.withColumn("cells", cells(F.col(vec_col)))


def tree_cells(asked: DataFrame, centroids: DataFrame, n: int) -> DataFrame:
    """The ``n`` nearest of very many centroids, exactly: query_id, neighbor_id (the cell), distance, rank.

    Centroids hang under about the square root of their number of roots, and only the roots are shipped, each with the radius of its group.
    A query first searches the groups of its nearest roots that hold ``n`` centroids; no group whose root lies further away than
    that ``n``-th distance and its radius can hold a nearer one, so only the others are searched after that.
    """
    cells = settle(centroids.select(F.col("cell").alias("id"), F.col("centroid").cast("array<double>").alias("embedding")))
    size = cells.count()
    roots = math.ceil(math.sqrt(size))
    if roots > SMALL_CENTROID_ROWS:
        return knn_exact(cells, asked, n)
    centres = settle(kmeans(cells, roots, max_iter=TREE_STEPS))
    grouped = settle(assign_nearest(cells, centres))
    reach = grouped.join(F.broadcast(centres), "cell").groupBy("cell").agg(  # as few rows as there are roots
        F.max(l2("embedding", "centroid")).alias("radius"), F.count("*").alias("members"))
    top = fetch_if_small(reach.join(centres, "cell").orderBy("cell").select("cell", "centroid", "radius", "members"), SMALL_CENTROID_ROWS)
    names, radius, members = (top[c].to_numpy() for c in ("cell", "radius", "members"))
    shared = asked.sparkSession.sparkContext.broadcast((names.astype(np.int32), matrix(top["centroid"]), radius, members))

    def far(batch: pa.Array) -> np.ndarray:
        x, (_, c, _, _) = matrix(batch).astype(np.float64), shared.value
        return np.sqrt(np.maximum(np.concatenate([((x[lo:lo + 256, None] - c) ** 2).sum(axis=2) for lo in range(0, len(x), 256)]), 0))

    def lists(rows: list[np.ndarray]) -> pa.Array:
        return pa.array([r.tolist() for r in rows], pa.list_(pa.int32()))

    def nearest_groups(d: np.ndarray) -> list[np.ndarray]:
        names, _, _, members = shared.value
        order = np.argsort(d, axis=1, kind="stable")
        enough = (np.cumsum(members[order], axis=1) < n).sum(axis=1) + 1
        return [o[:k] for o, k in zip(order, enough)]

    @arrow_column("array<int>")
    def first(batch: pa.Array) -> pa.Array:
        return lists([shared.value[0][g] for g in nearest_groups(far(batch))] if len(batch) else [])

    @arrow_column("array<int>")
    def others(batch: pa.Array, bound: pa.Array) -> pa.Array:
        if not len(batch):
            return lists([])
        names, _, radius, _ = shared.value
        d = far(batch)
        # Rounding must not shut out a group at the very distance.
        may = d - radius <= bound.to_numpy()[:, None] + 1e-9 * (1 + d)
        for row, g in zip(may, nearest_groups(d)):
            row[g] = False
        return lists([names[row] for row in may])

    probes = settle(asked.select("query_id", F.explode(first(F.col("query_vec"))).alias("cell")))
    found = settle(search_cells(grouped, probes, asked, n))
    bound = found.groupBy("query_id").agg(F.max("distance").alias("bound"))
    more = asked.join(bound, "query_id").select("query_id", F.explode(others(F.col("query_vec"), F.col("bound"))).alias("cell"))
    rest = search_cells(grouped, settle(more), asked, n)
    return top_n(found.drop("rank").unionByName(rest.drop("rank")), n)


def assign_nearest(base: DataFrame, centroids: DataFrame) -> DataFrame:
    """The input with its nearest ``cell``."""
    return nearest_cells(base, "id", "embedding", centroids, 1).withColumn(
        "cell", F.col("cells")[0]).drop("cells")


def lloyd_step(base: DataFrame, centroids: DataFrame) -> DataFrame:
    """Assign every row, then average each cell: cell, centroid. An empty cell keeps its place."""
    means = (
        assign_nearest(base, centroids)
        .groupBy("cell")
        .agg(vector_to_array(Summarizer.mean(
            array_to_vector(F.col("embedding").cast("array<double>")))).alias("mean"))
    )
    return centroids.join(means, "cell", "left").select(
        "cell", F.coalesce("mean", F.col("centroid").cast("array<double>")).alias("centroid"))


def probe_cells(queries: DataFrame, centroids: DataFrame, nprobe: int) -> DataFrame:
    """The ``nprobe`` nearest cells of each query: query_id, cell."""
    return nearest_cells(queries, "query_id", "query_vec", centroids, nprobe).select(
        "query_id", F.explode_outer("cells").alias("cell"))


def cell_sizes(assigned: DataFrame, by: str = "cell") -> DataFrame:
    """Members per cell / bucket / partition, counted with map-side combine."""
    return assigned.groupBy(by).agg(F.count("*").alias("members"))


def cell_candidates(probes: DataFrame, assigned: DataFrame, by: str = "cell") -> DataFrame:
    """Non-empty probed cells with their size: query_id, cell, members."""
    return probes.join(cell_sizes(assigned, by), by).select("query_id", by, "members")


def keyed_by(assigned: DataFrame, by: str = "cell", vector: str = "embedding") -> DataFrame:
    """id, embedding, keys form of a table grouped by one column."""
    return assigned.select("id", by, F.col(vector).alias("embedding"),
                           F.array(F.col(by).cast("string")).alias("keys"))


def search_cells(assigned: DataFrame, probes: DataFrame, queries: DataFrame, n: int | None,
                 by: str = "cell", vector: str = "embedding", **how) -> DataFrame:
    """Top ``n`` (or all within ``radius=``) among the rows of the probed cells."""
    own = ["query_vec"] if "query_vec" in probes.columns else []
    keys = probes.select("query_id", F.col(by).cast("string").alias("key"), *own)
    return search_keyed(keyed_by(assigned, by, vector), keys, queries, n, key_column=by, **how)


def search_ivfflat(base: DataFrame, queries: DataFrame, n: int, p: IvfParams = IvfParams(),
                   centroids: DataFrame | None = None, assigned: DataFrame | None = None,
                   **how) -> DataFrame:
    """Approximate top ``n`` with exact distances inside the probed cells."""
    if centroids is None:
        centroids = kmeans(base, p.nlist, p.seed, p.restarts)
    assigned = assign_nearest(base, centroids) if assigned is None else assigned
    return search_cells(assigned, probe_cells(queries, centroids, p.nprobe), queries, n, **how)


def range_search(assigned: DataFrame, centroids: DataFrame, queries: DataFrame, radius: float,
                 nprobe: int = 10, **how) -> DataFrame:
    """Every row of the probed cells within ``radius`` (inclusive)."""
    return search_cells(assigned, probe_cells(queries, centroids, nprobe), queries, None,
                        radius=radius, **how)
