"""Search on a grid: blocks of queries by stripes of the base, one task per cell.

A task reads the queries of its block first and then lets the rows of its stripe stream past them, each batch
against the bounds that the batches before have left, so a stripe may be of any length. Winners per query grow with the number
of stripes, base rows travel once per block of queries; the shape keeps both few for the work there is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, top_n, type_of
from .kernels import BestN, FlatScorer, id_values, key_groups, matrix, without_spare_copies

# Multiplications a task is given at most, queries of a block, and bytes of their vectors.
TASK_WORK = 1_000_000_000_000
BLOCK_QUERIES = 32_768
BLOCK_BYTES = 32 * 1024 * 1024
STRIPE_ROWS = 2_000_000
# Queries scored together inside a task.
CHUNK = 2_048
# Rows that a task scores before any others; then at most as many as it has seen.
FIRST = 1_024
# From so many stripes on, a pass over one row in PILOT_SHARE gives every query a bound beforehand.
PILOT_STRIPES = 128
PILOT_SHARE = 64
# Bytes of vectors that a stripe of rows with keys has at most.
STRIPE_BYTES = 128 * 1024 * 1024
# (query, key) probes of a block at most: behind many tables they take more than the vectors of its queries.
BLOCK_PROBES = 4 * 1024 * 1024
# Keys that travel in one row: a batch of whole key lists would be many times its vectors.
KEYS_A_ROW = 16
# Pairs found behind keys that are held at most until they give new bounds.
HELD_PAIRS = 250_000


def shape(rows: int, queries: int, dim: int, cores: int, *, work: float | None = None,
          base_block: int | None = None, query_block: int | None = None) -> tuple[int, int]:
    """(blocks of queries, stripes of the base).

    For a given number of tasks the rows that travel, ``blocks * rows + stripes * queries``, are fewest where both terms are
    alike; a block has no more queries than fit a task. ``work``: multiplications, if fewer than all pairs take.
    """
    rows, queries = max(rows, 1), max(queries, 1)
    widest = query_block or max(1, min(BLOCK_QUERIES, BLOCK_BYTES // (8 * max(dim, 1))))
    tasks = max(cores, math.ceil((work if work is not None else rows * queries * dim) / TASK_WORK))
    blocks = max(math.ceil(queries / widest), min(queries, round(math.sqrt(tasks * queries / rows))), 1)
    stripes = math.ceil(rows / base_block) if base_block else max(math.ceil(tasks / blocks), math.ceil(rows / STRIPE_ROWS))
    return blocks, max(1, min(stripes, rows))


class Asked:
    """The queries of one task, what they probe, and their best rows so far.

    Without ``probes`` all of them see all rows, which then lie behind ``key``; with ``take`` a query sees rows up to that position.
    """

    def __init__(self, ids, vectors, n: int | None, scorer, probes: dict | None = None, bound=None, dedupe: bool = False,
                 radius: float | None = None, key=None, take=None):
        self.ids, self.vectors, self.n, self.scorer = ids, vectors, n, scorer
        self.probes, self.dedupe, self.radius, self.key, self.take = probes, dedupe, radius, key, take
        self.start, self.seen = np.full(len(ids), np.inf) if bound is None else bound, 0
        self.fresh()

    def fresh(self) -> None:
        self.best = BestN(len(self.ids), self.n, self.dedupe)
        self.best.bound[:] = self.start

    def _meet(self, key, who, take, ids, vectors, members, pos):
        """(query row, batch row, squared distance) worth keeping behind one key."""
        if take is None and self.n is not None:
            members = members[without_spare_copies(vectors[members], ids[members], self.n)]
        for lo in range(0, len(who), CHUNK):
            part = who[lo:lo + CHUNK]
            visible = None if take is None else pos[members][None, :] <= take[lo:lo + CHUNK, None]
            bound = self.best.bound[part] if self.radius is None else np.full(len(part), self.radius ** 2)
            q, b, d2 = self.scorer.pairs(key, self.vectors[part], vectors[members], self.n, bound, visible)
            if self.radius is not None:
                keep = np.sqrt(d2) <= self.radius
                q, b, d2 = q[keep], b[keep], d2[keep]
            yield part[q], members[b], d2

    def add(self, ids, vectors, keys=None, pos=None) -> None:
        """Let a batch of base rows pass; without ``keys`` every query sees every row."""
        # The first rows give bounds that spare work on the others; behind many keys there are few rows each, so those stay together.
        while self.probes is None and self.n is not None and len(ids) > max(FIRST, self.seen):
            few, rest = slice(None, max(FIRST, self.seen)), slice(max(FIRST, self.seen), None)
            self._pass(ids[few], vectors[few], None, None if pos is None else pos[few])
            ids, vectors, pos = ids[rest], vectors[rest], None if pos is None else pos[rest]
        self._pass(ids, vectors, keys, pos)

    def _pass(self, ids, vectors, keys, pos) -> None:
        self.seen += len(ids)
        found, held = [], 0
        if self.probes is None:
            found += self._meet(self.key, np.arange(len(self.ids)), self.take, ids, vectors, np.arange(len(ids)), pos)
        else:
            for key, members in key_groups(keys):
                if key in self.probes:
                    for pairs in self._meet(key, *self.probes[key], ids, vectors, members, pos):
                        found.append(pairs)
                        held += len(pairs[0])
                        # A query meets a batch through many keys; what the first ones gave bounds the others.
                        if self.n is not None and held >= HELD_PAIRS:
                            self._settle(found, ids)
                            found, held = [], 0
        self._settle(found, ids)

    def _settle(self, found, ids) -> None:
        if found:
            q, b, d2 = (np.concatenate(x) for x in zip(*found))
            self.best.add(q, d2, ids[b])

    def winners(self, names, types) -> Iterator[pa.RecordBatch]:
        best = self.best
        if best.ids is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.ids[best.q], type=types[0]), pa.array(best.ids, type=types[1]),
                 pa.array(np.sqrt(best.d2), type=pa.float64())], names=names)


OUT = ["query_id", "neighbor_id", "distance"]


class Arriving:
    """The queries of a cell while they come in. Keys become numbers at once, so that no more than one batch of them is held as text."""

    def __init__(self, keyed: bool):
        self.keyed, self.ids, self.vectors, self.bounds = keyed, [], [], []
        # The number of every key; of every row its query, of every (row, key) the row and the key's number.
        self.numbers, self.of_row, self.rows, self.codes, self.seen = {}, [], [], [], 0

    def add(self, batch: pa.RecordBatch) -> None:
        if self.keyed:
            self._number(id_values(batch.column("query_id")), batch.column("keys"))
            batch = batch.filter(pc.equal(batch.column("piece"), 0))
            if not batch.num_rows:
                return
        self.ids.append(id_values(batch.column("query_id")))
        self.vectors.append(matrix(batch.column("vec")))
        self.bounds.append(batch.column("bound").to_numpy().copy())

    def _number(self, ids: np.ndarray, keys: pa.ListArray) -> None:
        coded = keys.flatten().dictionary_encode()
        numbers = np.array([self.numbers.setdefault(k, len(self.numbers)) for k in coded.dictionary.to_pylist()], dtype=np.int32)
        self.codes.append(numbers[coded.indices.to_numpy()])
        self.rows.append(np.repeat(np.arange(self.seen, self.seen + len(ids), dtype=np.int32), np.diff(keys.offsets.to_numpy())))
        self.of_row.append(ids)
        self.seen += len(ids)

    def asked(self, n: int | None, scorer, radius) -> Asked:
        if len({v.shape[1] for v in self.vectors}) > 1:
            raise ValueError("vectors must have one common length")
        ids, vectors, bounds = (np.concatenate(x) for x in (self.ids, self.vectors, self.bounds))
        return Asked(ids, vectors, n, scorer, self._probes(ids) if self.keyed else None, bounds, self.keyed, radius)

    def _probes(self, ids: np.ndarray) -> dict:
        by_id = np.argsort(ids).astype(np.int32)
        query = by_id[np.searchsorted(ids[by_id], np.concatenate(self.of_row))]
        codes, who = np.concatenate(self.codes), query[np.concatenate(self.rows)]
        self.of_row = self.rows = self.codes = None
        order = np.lexsort((who, codes))
        cuts = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(self.numbers)))])
        who = who[order]
        return {key: (who[cuts[i]:cuts[i + 1]], None) for key, i in self.numbers.items()}


def _dealt(left: DataFrame, right: DataFrame, cells: int) -> DataFrame:
    """Rows of every cell in a partition of its own, queries (side 0) first."""
    return left.unionByName(right).repartitionById(cells, F.col("cell")).sortWithinPartitions("side")


def _search(rows: DataFrame, schema: str, n: int | None, radius, scorer, keyed: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, arriving, types = None, Arriving(keyed), None
        for batch in batches:
            if not batch.num_rows:
                continue
            side = batch.column("side").to_numpy(zero_copy_only=False)
            n_q = int((side == 0).sum())
            if n_q:
                arriving.add(batch.slice(0, n_q))
            if n_q == batch.num_rows:
                continue
            if asked is None:
                if not arriving.ids:  # nobody asks here
                    return
                asked, arriving = arriving.asked(n, scorer or FlatScorer(), radius), None
                types = (batch.column("query_id").type, batch.column("id").type)
            rest = batch.slice(n_q)
            asked.add(id_values(rest.column("id")), matrix(rest.column("vec")), rest.column("keys") if keyed else None)
            if n is None:
                yield from asked.winners(OUT, types)
                asked.fresh()
        if asked is not None:
            yield from asked.winners(OUT, types)

    return rows.drop("cell").mapInArrow(run, schema)


def _sides(base: DataFrame, queries: DataFrame, keyed: bool) -> tuple[list, list]:
    """Common columns of both sides: side, query_id, id, vec, bound [, keys, piece]."""
    wide = "array<double>" in (type_of(base, "embedding"), type_of(queries, "query_vec"))
    vec_type = "array<double>" if wide else "array<float>"
    no_bound = F.lit(None).cast("double").alias("bound")
    left = [F.lit(1).alias("side"), F.lit(None).cast(type_of(queries, "query_id")).alias("query_id"), "id",
            F.col("embedding").cast(vec_type).alias("vec"), no_bound]
    bound = F.col("bound") if "bound" in queries.columns else F.lit(float("inf"))
    right = [F.lit(0).alias("side"), "query_id", F.lit(None).cast(type_of(base, "id")).alias("id"),
             F.col("query_vec").cast(vec_type).alias("vec"), F.coalesce(bound, F.lit(float("inf"))).alias("bound")]
    return (left + ["keys", F.lit(0).alias("piece")], right + ["keys", "piece"]) if keyed else (left, right)


def _schema(base: DataFrame, queries: DataFrame) -> str:
    return f"query_id {type_of(queries, 'query_id')}, neighbor_id {type_of(base, 'id')}, distance double"


def _each(column: str, n: int):
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(column)


def _pieces(column: str):
    """The list in stretches of ``KEYS_A_ROW``, one at least."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(column), F.lit(1)), F.lit(KEYS_A_ROW))
    return F.transform(starts, lambda at: F.slice(column, at, F.lit(KEYS_A_ROW)))


def all_pairs(base: DataFrame, queries: DataFrame, n: int, blocks: int, stripes: int, scorer=None) -> DataFrame:
    """The best ``n`` rows of every stripe for every query: query_id, neighbor_id, distance.

    ``queries`` may carry a ``bound``: a squared distance that rows beyond it need not be looked at.
    """
    left, right = _sides(base, queries, False)
    stripe, block = F.pmod(F.xxhash64("id"), F.lit(stripes)).cast("int"), F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")
    rows = base.select("id", "embedding", stripe.alias("stripe"), _each("block", blocks))
    asked = queries.select(*queries.columns, block.alias("block"), _each("stripe", stripes))
    cell = (F.col("block") * stripes + F.col("stripe")).alias("cell")
    return _search(_dealt(rows.select(cell, *left), asked.select(cell, *right), blocks * stripes), _schema(base, queries), n, None, scorer, False)


def knn_grid(base: DataFrame, queries: DataFrame, n: int, *, rows: int, asked: int, dim: int, base_block: int | None = None,
             query_block: int | None = None, scorer=None) -> DataFrame:
    """Exact top ``n`` of every query among all rows; ``rows`` and ``asked`` are the counted sizes of both sides.

    With very many stripes a first pass over a share of the base leaves every query a bound, so that the stripes return few rows beyond
    the final ones: about ``n * PILOT_SHARE`` a query instead of ``n`` a stripe.
    """
    cores = base.sparkSession.sparkContext.defaultParallelism
    blocks, stripes = shape(rows, asked, dim, cores, base_block=base_block, query_block=query_block)
    queries = queries.select("query_id", "query_vec")
    if stripes >= PILOT_STRIPES:
        some = base.where(F.pmod(F.xxhash64(F.lit(1), F.col("id")), F.lit(PILOT_SHARE)) == 0)
        first = top_n(all_pairs(some, queries, n, blocks, math.ceil(stripes / PILOT_SHARE), scorer), n)
        # Rounding of the root and the square must not shut out the row that gave the bound.
        bound = (F.max("distance") * F.max("distance") * (1 + 1e-12)).alias("bound")
        known = settle(first.groupBy("query_id").agg(bound, F.count("*").alias("found")).where(F.col("found") == n).drop("found"))
        queries = queries.join(known, "query_id", "left")
    return top_n(all_pairs(base, queries, n, blocks, stripes, scorer), n)


def keyed_grid(index: DataFrame, probes: DataFrame, queries: DataFrame, n: int | None, blocks: int, stripes: int, *,
               radius: float | None = None, scorer=None) -> DataFrame:
    """Winners of every cell among rows behind probed keys; a (query, row) pair meets in one cell only, through however many keys.

    ``index``: id, embedding, keys ARRAY. Which blocks ask for which keys is settled on ids and keys alone; a vector joins last, and travels once
    per block of queries that asks for it instead of once per key.
    """
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block")
    wanted = probes.select(F.col("key"), block).distinct()
    met = (index.select("id", F.explode_outer("keys").alias("key")).join(wanted, "key").groupBy("id").agg(F.collect_set("block").alias("blocks")))
    stripe = F.pmod(F.xxhash64("id"), F.lit(stripes)).cast("int")
    rows = index.select("id", "embedding", "keys").join(met, "id").select("id", "embedding", "keys", stripe.alias("stripe"), F.explode("blocks").alias("block"))
    keys = probes.groupBy("query_id").agg(F.collect_set("key").alias("keys"))
    asked = queries.select("query_id", "query_vec").join(keys, "query_id").select("query_id", "query_vec", F.posexplode(_pieces("keys")).alias("piece", "keys"))
    # The vector goes with the first keys only.
    asked = asked.withColumn("query_vec", F.when(F.col("piece") == 0, F.col("query_vec")))
    left, right = _sides(index, asked, True)
    asked = asked.select("query_id", "query_vec", "keys", "piece", block, _each("stripe", stripes))
    cell = (F.col("block") * stripes + F.col("stripe")).alias("cell")
    return _search(_dealt(rows.select(cell, *left), asked.select(cell, *right), blocks * stripes), _schema(index, queries), n, radius, scorer, True)
