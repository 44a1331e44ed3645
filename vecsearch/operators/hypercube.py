"""Binary projection: vectors sit on the vertices of a k-cube, queries read nearby vertices."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import HashTable, dimension, hash_params
from .common import SMALL_CENTROID_ROWS, arrow_column, evaluated, settle
from .exact import knn_exact
from .kernels import matrix
from .keyed import search_keyed


@dataclass(frozen=True)
class CubeParams:
    k: int = 10
    max_checked: int = 1000
    probes: int = 5
    w: float = 4.0
    seed: int = 42


def vertex_column(vector: Column, params: HashTable, w: float) -> Column:
    """BIGINT bit mask; bit ``k-1-j`` is the parity of hash ``j``."""
    v, t = params.v.T, params.t
    weights = 1 << np.arange(len(t), dtype=np.int64)[::-1]

    @arrow_column("bigint")
    def vertex(batch: pa.Array) -> pa.Array:
        if len(batch) == 0:
            return pa.array([], type=pa.int64())
        bits = np.floor((matrix(batch) @ v + t) / w).astype(np.int64) % 2
        return pa.array(bits @ weights)

    return vertex(vector)


def cube_vertices(df: DataFrame, p: CubeParams, vec_col: str = "embedding") -> DataFrame:
    """The input with its ``vertex``."""
    params = hash_params(dimension(df, vec_col), p.k, 1, p.w, p.seed)[0]
    return df.withColumn("vertex", vertex_column(F.col(vec_col), params, p.w))


def probe_masks(k: int, probes: int) -> list[int]:
    """Bit flips in probing order: own vertex, then distance 1, 2, ... in position order."""
    flips = (sum(1 << (k - 1 - j) for j in spots)
             for dist in range(k + 1) for spots in combinations(range(k), dist))
    # The own vertex is always read, whatever the budget.
    return list(islice(flips, max(probes, 1) if probes else 0))


def cube_probes(queries: DataFrame, p: CubeParams) -> DataFrame:
    """Vertices each query reads: query_id, probe_rank, vertex."""
    masks = probe_masks(p.k, p.probes)
    flips = F.array(*[F.lit(m).cast("bigint") for m in masks]) if masks else F.array().cast(
        "array<bigint>")
    own = cube_vertices(queries, p, "query_vec")
    return own.select("query_id", "vertex", F.posexplode(flips).alias("probe_rank", "flip")).select(
        "query_id", "probe_rank", F.col("vertex").bitwiseXOR(F.col("flip")).alias("vertex"))


def cube_members(base: DataFrame, p: CubeParams, salts: int = 64) -> DataFrame:
    """The rows any query can ever check, with their place in the vertex: ..., vertex, pos.

    A query stops after ``max_checked`` rows, so only the first ``max_checked`` rows of a vertex
    (in insertion order) matter: at most ``2^k * max_checked`` rows whatever the base size. The
    last insertion number of each vertex is found on narrow rows: every task keeps its own first
    rows per vertex (map-side group limit), groups of tasks are merged first and the vertex last,
    so a vertex holding a large share of the base never meets in one task. Vectors are only moved
    for the rows that stay.
    """
    order = "ord" if "ord" in base.columns else "id"
    at = evaluated(cube_vertices(base, p))  # read for the last places and again for the rows
    group = Window.partitionBy("vertex", "salt").orderBy("at")
    whole = Window.partitionBy("vertex").orderBy("at")
    few = F.col("place") <= p.max_checked
    last = (
        at.select("vertex", F.col(order).alias("at"), F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"))
        .withColumn("place", F.row_number().over(group)).where(few).select("vertex", "at")
        .withColumn("place", F.row_number().over(whole)).where(few)
        .groupBy("vertex").agg(F.max("at").alias("last"))
    )
    if 2 ** p.k <= SMALL_CENTROID_ROWS:  # one row per vertex
        last = F.broadcast(last)
    within = Window.partitionBy("vertex").orderBy(order)
    return (
        at.join(last, "vertex").where(F.col(order) <= F.col("last")).drop("last")
        .withColumn("pos", F.row_number().over(within).cast("bigint"))
        .where(F.col("pos") <= p.max_checked)
    )


def cube_candidates(members: DataFrame, queries: DataFrame, p: CubeParams) -> DataFrame:
    """What each query takes from each vertex: query_id, probe_rank, vertex, members, take.

    ``members`` is the vertex size (counted up to the cap), ``take`` how many of its first rows
    are checked before the cap is spent. Vertices that give nothing are left out.
    """
    sizes = members.groupBy("vertex").agg(F.count("*").alias("members"))
    before = Window.partitionBy("query_id").orderBy("probe_rank").rowsBetween(
        Window.unboundedPreceding, -1)
    return (
        cube_probes(queries, p).join(sizes, "vertex")
        .withColumn("spent", F.coalesce(F.sum("members").over(before), F.lit(0)))
        .withColumn("take", F.least("members", F.greatest(F.lit(p.max_checked) - F.col("spent"),
                                                          F.lit(0))))
        .where("take > 0").select("query_id", "probe_rank", "vertex", "members", "take")
    )


def search_hypercube(base: DataFrame, queries: DataFrame, n: int, p: CubeParams = CubeParams(),
                     members: DataFrame | None = None, **how) -> DataFrame:
    """Approximate top ``n``; queries that reach no row at all are answered exactly."""
    members = settle(cube_members(base, p)) if members is None else members
    index = members.select("id", "embedding", "pos",
                           F.array(F.col("vertex").cast("string")).alias("keys"))
    probes = settle(cube_candidates(members, queries, p).select(
        "query_id", F.col("vertex").cast("string").alias("key"), "take"))
    lost = queries.join(probes.select("query_id").distinct(), "query_id", "left_anti")
    found = search_keyed(index, probes, queries, n, **how)
    if lost.isEmpty():
        return found
    return found.unionByName(knn_exact(base, lost, n, **how))
