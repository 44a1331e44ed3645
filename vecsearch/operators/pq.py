"""Product quantisation of inverted-file residuals and table-lookup search on the codes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import dimension
from .common import SMALL_CENTROID_ROWS, arrow_column, fetch_if_small, settle
from .ivf import _from_start, assign_nearest, cell_sizes, kmeans, probe_cells, search_cells
from .kernels import AdcScorer, matrix, nearest_rows
from .lloyd import train


@dataclass(frozen=True)
class PqParams:
    nlist: int = 100
    nprobe: int = 10
    m: int = 8
    seed: int = 42
    restarts: int = 3
    pq_restarts: int = 2


# Sub-vector length -> number of codes per subspace.
MIN_SUB_DIM = 4
CODES_SHORT, CODES_MEDIUM, CODES_LONG = 16, 64, 256
MEDIUM_SUB_DIM, LONG_SUB_DIM = 10, 20


def fit_m(dim: int, m: int) -> int:
    """The requested number of subspaces, or the largest smaller divisor of the dimension."""
    return max(c for c in range(1, min(m, dim) + 1) if dim % c == 0)


def codes_for(sub_dim: int, rows: int | None = None) -> int:
    """Codes per subspace for a sub-vector length, never more than there are rows."""
    if sub_dim < MIN_SUB_DIM:
        raise ValueError(f"sub-vectors of length {sub_dim} are too short; use a smaller m")
    size = (CODES_SHORT if sub_dim < MEDIUM_SUB_DIM
            else CODES_MEDIUM if sub_dim < LONG_SUB_DIM else CODES_LONG)
    return size if rows is None else min(size, rows)


def coarse_cells(nlist: int, rows: int) -> int:
    """Number of coarse cells for a base of ``rows`` vectors."""
    return max(2, min(nlist, rows // 10))


def residuals(assigned: DataFrame, centroids: DataFrame, id_col: str = "id",
              vec_col: str = "embedding") -> DataFrame:
    """Vector minus the centroid of its cell: id, cell, residual.

    Centroids are subtracted inside the task once their size has been checked; a larger table is joined.
    """
    table = fetch_if_small(centroids.select("cell", "centroid"), SMALL_CENTROID_ROWS)
    if table is None:
        minus = F.zip_with(F.col(vec_col).cast("array<double>"), F.col("centroid"), lambda x, c: x - c)
        return assigned.join(centroids, "cell").select(id_col, "cell", minus.alias("residual"))
    names = table["cell"].to_numpy()
    order = np.argsort(names)
    shared = assigned.sparkSession.sparkContext.broadcast((names[order], matrix(table["centroid"]).astype(np.float64)[order]))

    @arrow_column("array<double>")
    def subtract(cells: pa.Array, vectors: pa.Array) -> pa.Array:
        if len(cells) == 0:
            return pa.array([], type=pa.list_(pa.float64()))
        names, centres = shared.value
        rows = matrix(vectors).astype(np.float64) - centres[np.searchsorted(names, cells.to_numpy())]
        offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1])
        return pa.ListArray.from_arrays(offsets, pa.array(rows.ravel()))

    return assigned.select(id_col, "cell", subtract(F.col("cell"), F.col(vec_col)).alias("residual"))


def split_subvectors(df: DataFrame, m: int, sub_dim: int, vec_col: str = "residual") -> DataFrame:
    """One row per (row, subspace), a short tail padded with zeros: ..., m, sub."""
    padded = F.concat(F.col(vec_col), F.array_repeat(F.lit(0.0), m * sub_dim))
    pieces = F.transform(F.sequence(F.lit(0), F.lit(m - 1)),
                         lambda i: F.slice(padded, i * sub_dim + 1, sub_dim))
    rest = [c for c in df.columns if c != vec_col]
    return df.select(*rest, F.posexplode(pieces).alias("m", "sub"))


def _book(codebook: DataFrame) -> np.ndarray:
    """(m, codes, sub_dim) array; size is bounded by the parameters and checked on the way."""
    table = fetch_if_small(codebook.select("m", "code", "centroid"), SMALL_CENTROID_ROWS * 16)
    if table is None:
        raise ValueError("codebook larger than m x 256 rows can be")
    m, code = (table[c].to_numpy() for c in ("m", "code"))
    values = matrix(table["centroid"])
    # A subspace with fewer codes keeps unreachable slots.
    book = np.full((m.max() + 1, code.max() + 1, values.shape[1]), np.inf)
    book[m, code] = values
    return book


def pq_encode(res: DataFrame, codebook: DataFrame) -> DataFrame:
    """Nearest code per subspace (lowest code on ties): id, cell, codes ARRAY<SMALLINT>."""
    return res.select("id", "cell", _codes(res, _book(codebook)).alias("codes"))


def _codes(res: DataFrame, book: np.ndarray) -> Column:
    shared = res.sparkSession.sparkContext.broadcast(book)

    @arrow_column("array<smallint>")
    def encode(batch: pa.Array) -> pa.Array:
        if len(batch) == 0:
            return pa.array([], type=pa.list_(pa.int16()))
        book = shared.value
        m, _, sub = book.shape
        rows = matrix(batch)
        rows = np.pad(rows, ((0, 0), (0, m * sub - rows.shape[1]))).reshape(len(rows), m, sub)
        out = np.empty((len(rows), m), dtype=np.int16)
        for j in range(m):
            used = np.nonzero(np.isfinite(book[j, :, 0]))[0].astype(np.int16)
            out[:, j] = nearest_rows(rows[:, j], book[j, used], used, 1)[:, 0]
        offsets = pa.array(np.arange(len(out) + 1, dtype=np.int32) * m)
        return pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))

    return encode(F.col("residual"))


def pq_lloyd_step(res: DataFrame, codebook: DataFrame) -> DataFrame:
    """One k-means step in all subspaces together: m, code, centroid."""
    book = _book(codebook)
    parts, _, sub = book.shape
    padded = F.concat(F.col("residual"), F.array_repeat(F.lit(0.0), parts * sub))
    pieces = F.transform(
        F.sequence(F.lit(0), F.lit(parts - 1)),
        lambda i: F.struct(i.alias("m"), F.get("codes", i).cast("int").alias("code"),
                           F.slice(padded, i * sub + 1, sub).alias("sub")))
    moved = (
        res.select("residual", _codes(res, book).alias("codes"))
        .select(F.explode_outer(pieces).alias("p"))
        .groupBy("p.m", "p.code")
        .agg(vector_to_array(Summarizer.mean(array_to_vector("p.sub"))).alias("mean"))
    )
    return codebook.join(moved, ["m", "code"], "left").select(
        "m", "code", F.coalesce("mean", "centroid").alias("centroid"))


def pq_train(res: DataFrame, m: int = 8, seed: int = 42, restarts: int = 2,
             max_iter: int = 300, init: DataFrame | None = None) -> DataFrame:
    """Codebook by k-means in each subspace, restarts and subspaces advanced together in one scan per step: m, code, centroid.

    With ``init`` (m, code, centroid) one run of at most ``max_iter`` steps from that start in all subspaces together.
    """
    if init is not None:
        res = settle(res.select("residual"))
        return _from_start(init, lambda book: pq_lloyd_step(res, book), ["m", "code"], max_iter)
    dim = dimension(res, "residual")
    m = fit_m(dim, m)
    res = settle(res.select("residual"))
    size = codes_for(dim // m, res.limit(CODES_LONG).count())
    slices = [(j * (dim // m), (j + 1) * (dim // m)) for j in range(m)]
    found = train(res.select(F.col("residual").alias("embedding")), slices, size, seed, restarts, max_iter)
    rows = [(j, code, centre) for j, p in enumerate(found) for code, centre in enumerate(p.centres.tolist())]
    return res.sparkSession.createDataFrame(rows, "m int, code int, centroid array<double>")


def adc_distances(codes: DataFrame, probes: DataFrame, queries: DataFrame, centroids: DataFrame,
                  codebook: DataFrame, n: int, **how) -> DataFrame:
    """Top ``n`` by approximate distance between query residuals and codes."""
    table = fetch_if_small(centroids.select("cell", "centroid"), SMALL_CENTROID_ROWS)
    if table is None:  # every probe then carries its own residual instead
        cell = centroids.select("cell", F.col("centroid").cast("array<double>").alias("centroid"))
        minus = F.zip_with(F.col("query_vec").cast("array<double>"), F.col("centroid"), lambda x, c: x - c)
        own = probes.select("query_id", "cell").join(queries.select("query_id", "query_vec"), "query_id").join(cell, "cell").select(
            "query_id", "cell", minus.alias("query_vec"))
        shared = codes.sparkSession.sparkContext.broadcast((None, _book(codebook)))
        return search_cells(codes, own, queries, n, vector="codes", scorer=AdcScorer(shared), **{**how, "strategy": "blocks"})
    cells = dict(zip((str(c) for c in table["cell"].to_pylist()), matrix(table["centroid"]),
                     strict=True))
    shared = codes.sparkSession.sparkContext.broadcast((cells, _book(codebook)))
    return search_cells(codes, probes, queries, n, vector="codes", scorer=AdcScorer(shared), **how)


def search_ivfpq(base: DataFrame, queries: DataFrame, n: int, p: PqParams = PqParams(),
                 centroids: DataFrame | None = None, codebook: DataFrame | None = None,
                 codes: DataFrame | None = None, **how) -> DataFrame:
    """Approximate top ``n`` by quantised distance (no re-ranking)."""
    if centroids is None:
        centroids = kmeans(base, coarse_cells(p.nlist, base.count()), p.seed, p.restarts)
    if codes is None:
        res = residuals(assign_nearest(base, centroids), centroids)
        if codebook is None:
            codebook = pq_train(res, p.m, p.seed, p.pq_restarts)
        codes = pq_encode(res, codebook)
    return adc_distances(codes, probe_cells(queries, centroids, p.nprobe), queries, centroids,
                         codebook, n, **how)


def pq_stats(codes: DataFrame, codebook: DataFrame, m: int, sub_dim: int) -> DataFrame:
    """Index figures, one row per subspace: m, n_vectors, n_cells, n_subspaces, sub_dim, codes_used."""
    sizes = cell_sizes(codes)
    used = (
        codes.select(F.posexplode_outer("codes").alias("m", "code")).groupBy("m", "code").count()
        .groupBy("m").agg(F.count("*").alias("codes_used"))
    )
    return codebook.select("m").distinct().join(used, "m", "left").select(
        "m", sizes.agg(F.sum("members")).scalar().alias("n_vectors"),
        sizes.agg(F.count("*")).scalar().alias("n_cells"), F.lit(m).cast("bigint").alias("n_subspaces"),
        F.lit(sub_dim).cast("bigint").alias("sub_dim"),
        F.coalesce("codes_used", F.lit(0)).alias("codes_used"))
