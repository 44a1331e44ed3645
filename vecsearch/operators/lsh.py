"""Euclidean hashing with several tables, multi-probe lookup and a bucket-walk fallback.

Work is planned on *buckets*, not on (query, candidate) pairs: the steps below decide which
buckets a query reads, and the keyed search scores their members in place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import HashTable, dimension, hash_params, projection_codes
from .common import arrow_column, evaluated, settle, stored, type_of
from .kernels import matrix
from .keyed import search_keyed

# Probes that may be settled on the driver; where there can be more they are written to the shared folder without a trial.
DRIVER_PROBES = 250_000


@dataclass(frozen=True)
class LshParams:
    k: int = 10
    tables: int = 5
    w: float = 4.0
    seed: int = 42
    radius: int = 1
    fallback: bool = True


def _key_bytes(h: np.ndarray) -> pa.Array:
    """(rows, tables, k) hash values -> one binary key per (row, table): table number, then values."""
    rows, tables, k = h.shape
    full = np.empty((rows, tables, k + 1), dtype="<i4")
    full[:, :, 0] = np.arange(tables)
    full[:, :, 1:] = h
    fixed = pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(4 * (k + 1)), rows * tables, [None, pa.py_buffer(full.tobytes())])
    return fixed.cast(pa.binary())


def _hashes(vectors: np.ndarray, params: list[HashTable], w: float) -> np.ndarray:
    v, t = np.concatenate([p.v for p in params]).T, np.concatenate([p.t for p in params])
    h = np.floor((vectors @ v + t) / w).astype("<i4")
    return h.reshape(len(h), len(params), -1)


def code_text(key: Column) -> Column:
    """Readable form of a bucket key: the hash values joined by commas."""
    @arrow_column("string")
    def text(keys: pa.Array) -> pa.Array:
        return pa.array([",".join(map(str, np.frombuffer(b, dtype="<i4")[1:])) for b in keys.to_pylist()],
                        type=pa.string())

    return text(key)


def lsh_index(base: DataFrame, p: LshParams, dim: int | None = None) -> DataFrame:
    """The input with ``keys``, one binary bucket key per table; one row per vector."""
    params = hash_params(dim or dimension(base), p.k, p.tables, p.w, p.seed)

    @arrow_column("array<binary>")
    def keys(batch: pa.Array) -> pa.Array:
        if len(batch) == 0:
            return pa.array([], type=pa.list_(pa.binary()))
        flat = _key_bytes(_hashes(matrix(batch), params, p.w))
        offsets = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * len(params))
        return pa.ListArray.from_arrays(offsets, flat)

    return base.withColumn("keys", keys(F.col("embedding")))


def lsh_codes(df: DataFrame, p: LshParams) -> DataFrame:
    """One row per (vector, table): id, tbl, code."""
    params = hash_params(dimension(df), p.k, p.tables, p.w, p.seed)
    codes = projection_codes(F.col("embedding"), params, p.w)
    parts = F.array(*[F.array_join(F.slice("codes", t * p.k + 1, p.k).cast("array<string>"), ",")
                      for t in range(p.tables)])
    return df.select("id", codes.alias("codes")).select("id", F.posexplode_outer(parts).alias("tbl", "code"))


def lsh_buckets(index: DataFrame) -> DataFrame:
    """Bucket sizes and first insertion position: tbl, key, members, first_ord."""
    order = "ord" if "ord" in index.columns else "id"
    return (
        index.select(F.col(order).alias("ord"), F.posexplode_outer("keys").alias("tbl", "key"))
        .groupBy("tbl", "key")
        .agg(F.count("*").alias("members"), F.min("ord").alias("first_ord"))
    )


def probe_keys(queries: DataFrame, p: LshParams, radius: int | None = None) -> DataFrame:
    """Buckets each query looks at: its own and those one coordinate (by up to radius) away.

    query_id, tbl, key; only the query side is expanded, never the base.
    """
    radius = p.radius if radius is None else radius
    params = hash_params(dimension(queries, "query_vec"), p.k, p.tables, p.w, p.seed)
    moves = np.zeros((1 + 2 * p.k * radius, p.k), dtype="<i4")
    deltas = [sign * d for d in range(1, radius + 1) for sign in (1, -1)]
    moves[1 + np.arange(p.k * len(deltas)), np.repeat(np.arange(p.k), len(deltas))] = deltas * p.k
    per_query = p.tables * len(moves)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, 200_000 // per_query)
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                h = _hashes(matrix(part.column("query_vec")), params, p.w)
                near = (h[:, None] + moves[None, :, None]).reshape(-1, p.tables, p.k)
                owner = pa.array(np.repeat(np.arange(part.num_rows), per_query))
                yield pa.RecordBatch.from_arrays(
                    [part.column("query_id").take(owner),
                     pa.array(np.tile(np.arange(p.tables, dtype=np.int32), len(near))),
                     _key_bytes(near)], names=["query_id", "tbl", "key"])

    return queries.select("query_id", "query_vec").mapInArrow(
        run, f"query_id {type_of(queries, 'query_id')}, tbl int, key binary")


def lsh_probes(index: DataFrame, queries: DataFrame, p: LshParams, radius: int | None = None,
               buckets: DataFrame | None = None) -> DataFrame:
    """Non-empty probed buckets: query_id, tbl, key, members."""
    buckets = lsh_buckets(index) if buckets is None else buckets
    return probe_keys(queries, p, radius).join(
        buckets.select("tbl", "key", "members"), ["tbl", "key"]
    ).select("query_id", "tbl", "key", "members")


def short_queries(queries: DataFrame, probes: DataFrame, n: int) -> DataFrame:
    """Queries not yet known to have ``2n`` candidates: no single table gives that many."""
    per_query = (
        probes.groupBy("query_id", "tbl").agg(F.sum("members").alias("m"))
        .groupBy("query_id").agg(F.max("m").alias("at_least"))
    )
    return (
        queries.select("query_id").join(per_query, "query_id", "left")
        .where(F.coalesce("at_least", F.lit(0)) < 2 * n).select("query_id")
    )


def lsh_fallback(index: DataFrame, queries: DataFrame, probes: DataFrame, buckets: DataFrame,
                 n: int, p: LshParams) -> DataFrame:
    """Extra buckets for queries with fewer than ``2n`` candidates: query_id, tbl, key, members.

    Rule: for each table of the first half, add whole buckets in first-insertion order and stop
    after the bucket that brings the candidates to at least ``10n``. Three facts keep this small:
    within one table buckets are disjoint, so a query with ``2n`` members probed in any single
    table needs no exact count; a walk never passes the first bucket whose running size reaches
    ``10n``, so it reads one prefix shared by all queries; and after the first table a walk has
    either reached ``10n`` or holds everything, so later tables contribute their first bucket.
    """
    nothing = probes.limit(0)
    if p.tables // 2 == 0:
        return nothing
    budget = 10 * n
    short = settle(short_queries(queries, probes, n))
    # At most 2n members per table and query from here on. A bucket of 2n or more cannot occur
    # behind a short query, so only small buckets take part in the join.
    members = index.select("id", F.col("keys")[0].alias("first_key"), F.explode_outer("keys").alias("key"))
    found = settle(
        probes.join(short, "query_id", "left_semi").select("query_id", "key")
        .join(members, "key")
        .select("query_id", "id", "first_key").distinct()
    )
    counted = short.join(found.groupBy("query_id").agg(F.count("*").alias("have")), "query_id", "left")
    thin = settle(counted.select("query_id", F.coalesce("have", F.lit(0)).alias("have")).where(
        F.col("have") < 2 * n))
    if thin.isEmpty():
        return nothing

    # Both lists are short whatever the base size: a distributed top 10n, and one row per table.
    oldest = buckets.where("tbl = 0").orderBy("first_ord").limit(budget).select("key", "members")
    walk, reached = [], 0
    for bucket in oldest.collect():
        if reached < budget:
            walk.append(bucket)
        reached += bucket["members"]
    heads = (
        buckets.where((F.col("tbl") > 0) & (F.col("tbl") < p.tables // 2)).groupBy("tbl")
        .agg(F.min_by(F.struct("key", "members"), "first_ord").alias("b"))
        .select("tbl", "b.key", "b.members").collect()
    )

    if not walk:
        return nothing

    def each(rows: list[dict]) -> Column:
        """The listed buckets as one exploded array constant."""
        columns = {"tbl": [r["tbl"] for r in rows], "place": list(range(1, len(rows) + 1)),
                   "key": [bytes(r["key"]).hex() for r in rows], "members": [r["members"] for r in rows]}
        kinds = {"tbl": "array<int>", "place": "array<int>", "key": "array<string>", "members": "array<bigint>"}
        return F.explode(F.arrays_zip(*[F.lit(v).cast(kinds[c]).alias(c) for c, v in columns.items()]))

    known = (
        found.join(thin, "query_id", "left_semi")
        .groupBy("query_id", F.col("first_key").alias("key")).agg(F.count("*").alias("known"))
    )
    along = Window.partitionBy("query_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    stepped = (
        thin.select("query_id", "have", each([{"tbl": 0, **b.asDict()} for b in walk]).alias("s"))
        .select("query_id", "have", F.unhex("s.key").alias("key"), "s.tbl", "s.place", "s.members")
        .join(known, ["query_id", "key"], "left")
        .withColumn("new", F.col("members") - F.coalesce("known", F.lit(0)))
        .withColumn("total", F.col("have") + F.coalesce(F.sum("new").over(along), F.lit(0)))
        .where((F.col("total") < budget) | (F.col("place") == 1))
        .select("query_id", "tbl", "key", "members")
    )
    if not heads:
        return stepped
    later = thin.select("query_id", each([h.asDict() for h in heads]).alias("s")).select(
        "query_id", "s.tbl", F.unhex("s.key").alias("key"), "s.members")
    return stepped.unionByName(later)


def lsh_candidates(index: DataFrame, queries: DataFrame, n: int, p: LshParams) -> DataFrame:
    """All buckets a query reads, probed and fallback, each once: query_id, tbl, key, members."""
    buckets = settle(lsh_buckets(index))
    most = queries.count() * p.tables * (1 + 2 * p.k * p.radius)
    probes = lsh_probes(index, queries, p, buckets=buckets)
    probes = settle(probes) if most <= DRIVER_PROBES else stored(probes, "probes")
    if not p.fallback or short_queries(queries, probes, n).isEmpty():
        return probes
    extra = lsh_fallback(index, queries, probes, buckets, n, p)
    return settle(probes.unionByName(extra).distinct())


def search_lsh(base: DataFrame, queries: DataFrame, n: int, p: LshParams = LshParams(),
               index: DataFrame | None = None, **how) -> DataFrame:
    """Approximate top ``n``: query_id, neighbor_id, distance, rank.

    Pass a stored ``index`` (see ``lsh_index``) to skip hashing the base again.
    """
    index = evaluated(lsh_index(base, p) if index is None else index)  # buckets, fallback and search read it
    probes = lsh_candidates(index, queries, n, p).select("query_id", "key")
    return search_keyed(index, probes, queries, n, many_keys=p.tables, **how)
