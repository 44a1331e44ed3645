"""Bulk top-n / radius search of many queries against a table, restricted to matching keys.

Every search method reduces to the same job: a base row carries one or more bucket keys, a
query probes some keys, and the closest base rows behind the probed keys win. Three physical
forms, chosen by the measured size of the query side:

* **scan** - few queries: they travel to the tasks, the base is read once with no shuffle, every
  task returns its local best ``n`` per query.
* **blocks** - many queries: both sides are shuffled by key. A key holding more rows than a block
  is split by a salt (base side), and one probed by more queries than a block is split as well
  (query side), so no task ever holds more than one block of queries plus one Arrow batch,
  whatever share of the rows a single key has. Pairs are never materialised as rows. Blocks of queries grow with
  their number until they fill ``BLOCK_BYTES``, so that a row isn't sent to more blocks because there are more queries.

* **grid** (``grid.py``) - many queries that see all rows, or meet a row through several keys: blocks of queries by
  stripes of the base.

All return local winners; a window over ``query_id`` merges them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SMALL_PROBE_ROWS, SMALL_QUERY_ROWS, evaluated, fetch_if_small, settle, stored, stored_by, top_n, type_of
from .grid import BLOCK_BYTES, BLOCK_PROBES, OUT, STRIPE_BYTES, Asked, keyed_grid, knn_grid, shape
from .kernels import FlatScorer, id_values, matrix

BASE_BLOCK_ROWS = 50_000
# Queries of a block at least, and blocks of queries wanted per core.
QUERY_BLOCK_ROWS = 512
BLOCKS_A_CORE = 4
ANY_KEY = ""


def query_rows(probed: int, dim: int, cores: int) -> int:
    """Queries of a block: enough blocks for the cores where ``probed`` (query, key) rows are dealt to them, none above ``BLOCK_BYTES``."""
    return max(1, min(BLOCK_BYTES // (8 * max(dim, 1)), max(QUERY_BLOCK_ROWS, probed // (BLOCKS_A_CORE * cores))))


def search_keyed(
    base: DataFrame,
    probes: DataFrame,
    queries: DataFrame,
    n: int | None,
    *,
    radius: float | None = None,
    scorer=None,
    many_keys: int = 0,
    everywhere: bool = False,
    key_column: str | None = None,
    strategy: str = "auto",
    base_block: int | None = None,
    query_block: int | None = None,
) -> DataFrame:
    """Nearest base rows behind the probed keys.

    ``base``: id, embedding, keys ARRAY<STRING or BINARY> [, pos]; ``probes``: query_id, key [, take];
    ``queries``: query_id, query_vec (``probes`` may carry a ``query_vec`` per key instead, in blocks). With ``pos``/``take`` a probe sees only rows ``pos <= take``.
    ``key_column`` names a base column equal to the (single) key: a table partitioned by it is read only where probed.
    ``many_keys`` says through how many keys a base row can be met (duplicates are removed), ``everywhere`` that every query
    probes every row.
    """
    winners = None
    if strategy in ("auto", "scan"):
        q_table = fetch_if_small(queries.select("query_id", "query_vec"), SMALL_QUERY_ROWS)
        p_table = fetch_if_small(probes, SMALL_PROBE_ROWS) if q_table is not None else None
        if p_table is not None:
            if key_column:
                base = only_probed(base, base.sparkSession.createDataFrame(pa.table({"key": pc.unique(p_table["key"])})), key_column)
            winners = _scan(base, p_table, q_table, queries, n, radius, scorer or FlatScorer(), bool(many_keys))
        elif strategy == "scan":
            raise ValueError("query side too large for the scan strategy")
    if winners is None:
        asked = queries.groupBy("query_id").count().agg(F.sum("count").alias("rows"), F.max("count").alias("most")).first()
        if (asked["most"] or 0) > 1:
            raise ValueError("query ids are not unique")
        first = queries.select(F.size("query_vec")).first()
        dim, cores = (first[0] or 1) if first else 1, base.sparkSession.sparkContext.defaultParallelism
        size = {"base_block": base_block, "query_block": query_block}
        if everywhere:
            base = evaluated(base)
            return knn_grid(base, queries, n, rows=base.count(), asked=asked["rows"] or 0, dim=dim, scorer=scorer, **size)
        wanted = settle(probes.groupBy("key").agg(F.count("*").alias("asked")))
        probed = wanted.agg(F.sum("asked")).first()[0] or 0
        base_block, query_block = base_block or BASE_BLOCK_ROWS, query_block or query_rows(probed, dim, cores)
        if many_keys:
            base = evaluated(base)
            rows, met, by_keys = base.count(), *_travel(base, wanted, base_block, query_block)
            blocks, stripes = shape(rows, asked["rows"] or 0, dim, cores, work=met * dim, **size)
            blocks = max(blocks, math.ceil(probed / BLOCK_PROBES))
            if not size["base_block"]:
                stripes = max(stripes, math.ceil(4 * rows * dim / STRIPE_BYTES))
            if min(blocks * rows, met) + stripes * (asked["rows"] or 0) <= by_keys:
                grid = keyed_grid(base, probes, queries, n, blocks, stripes, radius=radius, scorer=scorer)
                return grid if n is None else top_n(grid, n)
        if key_column:
            base = only_probed(base, wanted.select("key"), key_column)
        winners = _blocks(base, probes, wanted, queries, n, radius, scorer or FlatScorer(), base_block, query_block)
    if many_keys:
        # One shuffle by query serves both the duplicate removal and the ranking window.
        winners = winners.repartition("query_id").dropDuplicates(["query_id", "neighbor_id"])
    if n is None:
        return winners
    return top_n(winners, n)


def only_probed(base: DataFrame, keys: DataFrame, key_column: str) -> DataFrame:
    """``base`` without rows of other keys, where it is stored by ``key_column``: Spark then opens the files of those keys alone.

    The keys are joined, so that their number doesn't matter to the plan (dynamic partition pruning); they are written first, as
    Spark prunes by a filtered table only. A base that isn't stored by the column stays as it is.
    """
    if key_column not in stored_by(base):
        return base
    wanted = stored(keys.select(F.col("key").cast(type_of(base, key_column)).alias(key_column)).distinct(), "probed")
    size = wanted.agg(F.count(F.lit(1)).alias("keys"), F.min(key_column).alias("least")).first()
    if size["keys"] > SMALL_PROBE_ROWS:
        return base
    if not size["keys"]:
        return base.limit(0)
    return base.join(F.broadcast(wanted.where(F.col(key_column) >= F.lit(size["least"]))), key_column, "left_semi")


def _travel(base: DataFrame, wanted: DataFrame, base_block: int, query_block: int) -> tuple[int, int]:
    """(pairs that meet behind keys, rows and queries that travel if both go by their keys)."""
    members = base.select(F.explode_outer("keys").alias("key")).groupBy("key").agg(F.count("*").alias("members"))
    sent = F.col("members") * F.ceil(F.col("asked") / query_block) + F.col("asked") * F.ceil(F.col("members") / base_block)
    total = members.join(wanted, "key").agg(F.sum(F.col("members") * F.col("asked")).alias("met"), F.sum(sent).alias("sent")).first()
    return total["met"] or 0, total["sent"] or 0


def _out_schema(base: DataFrame, queries: DataFrame) -> str:
    return (f"query_id {type_of(queries, 'query_id')}, neighbor_id {type_of(base, 'id')}, "
            "distance double")


def _scan(base, p_table, q_table, queries, n, radius, scorer, many_keys) -> DataFrame:
    spark = base.sparkSession
    q_ids = id_values(q_table["query_id"])
    q_order = np.argsort(q_ids, kind="stable")
    q_ids = q_ids[q_order]
    if (q_ids[1:] == q_ids[:-1]).any():
        raise ValueError("query ids are not unique")
    q_vecs = (matrix(q_table["query_vec"]).astype(np.float64)[q_order] if len(q_ids)
              else np.zeros((0, 0)))
    key_codes = p_table["key"].combine_chunks().dictionary_encode()
    rows = np.searchsorted(q_ids, id_values(p_table["query_id"]))
    takes = (p_table["take"].to_numpy() if "take" in p_table.column_names else None)
    order = np.argsort(key_codes.indices.to_numpy(), kind="stable")
    cuts = np.searchsorted(key_codes.indices.to_numpy()[order],
                           np.arange(len(key_codes.dictionary) + 1))
    probe_map = {}
    for i, key in enumerate(key_codes.dictionary.to_pylist()):
        picked = order[cuts[i]:cuts[i + 1]]
        probe_map[key] = (rows[picked], None if takes is None else takes[picked])
    shared = spark.sparkContext.broadcast((q_ids, q_vecs, probe_map))
    types = (q_table["query_id"].type, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q_vecs, probe_map = shared.value
        asked, id_type = Asked(q_ids, q_vecs, n, scorer, probe_map, dedupe=many_keys, radius=radius), None
        for batch in batches:
            if not batch.num_rows or not probe_map:
                continue
            id_type = batch.column("id").type
            pos = batch.column("pos").to_numpy(zero_copy_only=False) if "pos" in batch.schema.names else None
            asked.add(id_values(batch.column("id")), matrix(batch.column("embedding")), batch.column("keys"), pos)
            if n is None:
                yield from asked.winners(OUT, (types[0], id_type))
                asked.fresh()
        yield from asked.winners(OUT, (types[0], id_type))

    columns = ["id", "embedding", "keys"] + (["pos"] if takes is not None else [])
    return base.select(*columns).mapInArrow(run, _out_schema(base, queries))


def _blocks(base, probes, wanted, queries, n, radius, scorer, base_block, query_block) -> DataFrame:
    capped = "take" in probes.columns
    base = evaluated(base)  # read for the splits and again for the search
    # Outer: a plain explode would add a filter that runs the Python key function a second time.
    by_key = base.select("id", "embedding", F.explode_outer("keys").alias("key"),
                         *(["pos"] if capped else []))
    # Rows behind keys that nobody asks for don't travel.
    by_key = by_key.join(wanted.select("key"), "key", "left_semi")
    # Only keys above one block get an entry, so this table stays at most rows / block long.
    splits = settle(
        by_key.groupBy("key").agg(F.ceil(F.count("*") / base_block).alias("parts"))
        .where("parts > 1")
        .join(wanted.select("key", F.ceil(F.col("asked") / query_block).alias("q_parts")).where("q_parts > 1"), "key", "full")
        .select("key", F.coalesce("parts", F.lit(1)).alias("parts"),
                F.coalesce("q_parts", F.lit(1)).alias("q_parts"))
    )
    one = F.lit(1).cast("bigint")
    parts, q_parts = F.coalesce("parts", one), F.coalesce("q_parts", one)
    text = F.hex("key") if type_of(by_key, "key") == "binary" else F.col("key")
    block = F.concat_ws("|", text, F.col("salt").cast("string"), F.col("q_salt").cast("string"))
    no_cap = F.lit(None).cast("bigint")
    wide = "array<double>" in (type_of(by_key, "embedding"), type_of(queries, "query_vec"))
    vec_type = "array<double>" if wide else "array<float>"
    left = (
        by_key.join(splits, "key", "left")
        .withColumn("salt", F.pmod(F.xxhash64("id"), parts))
        .withColumn("q_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), q_parts - 1)))
        .select(block.alias("block"), "key", F.lit(1).alias("side"),
                F.lit(None).cast(type_of(queries, "query_id")).alias("query_id"), "id",
                F.col("embedding").cast(vec_type).alias("vec"),
                (F.col("pos").cast("bigint") if capped else no_cap).alias("cap"))
    )
    right = (
        (probes if "query_vec" in probes.columns else probes.join(queries.select("query_id", "query_vec"), "query_id"))
        .join(splits, "key", "left")
        .withColumn("q_salt", F.pmod(F.xxhash64("query_id"), q_parts))
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
        .select(block.alias("block"), "key", F.lit(0).alias("side"), "query_id",
                F.lit(None).cast(type_of(base, "id")).alias("id"),
                F.col("query_vec").cast(vec_type).alias("vec"),
                (F.col("take").cast("bigint") if capped else no_cap).alias("cap"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, asked, types = None, None, None
        q_ids, q_vecs, takes = [], [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            types = (batch.column("query_id").type, batch.column("id").type)
            for name, key, lo, hi in _runs(batch):
                if name != current:
                    if asked is not None:
                        yield from asked.winners(OUT, types)
                    current, asked, q_ids, q_vecs, takes = name, None, [], [], []
                side = batch.column("side").slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                n_q = int((side == 0).sum())
                if n_q:
                    q_ids.append(id_values(batch.column("query_id").slice(lo, n_q)))
                    q_vecs.append(matrix(batch.column("vec").slice(lo, n_q)))
                    takes.append(batch.column("cap").slice(lo, n_q).to_numpy(zero_copy_only=False))
                if n_q == hi - lo or not len(q_ids):
                    continue
                if asked is None:
                    asked = Asked(np.concatenate(q_ids), np.concatenate(q_vecs), n, scorer, radius=radius, key=key,
                                  take=np.concatenate(takes) if capped else None)
                at, size = lo + n_q, hi - lo - n_q
                pos = batch.column("cap").slice(at, size).to_numpy(zero_copy_only=False) if capped else None
                asked.add(id_values(batch.column("id").slice(at, size)), matrix(batch.column("vec").slice(at, size)), pos=pos)
                if n is None:
                    yield from asked.winners(OUT, types)
                    asked.fresh()
        if asked is not None:
            yield from asked.winners(OUT, types)

    return (
        left.unionByName(right)
        .repartition("block")
        .sortWithinPartitions("block", "side")
        .mapInArrow(run, _out_schema(base, queries))
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, str, int, int]]:
    """(block, key, start, end) of the equal-block stretches of a sorted batch."""
    codes = batch.column("block").dictionary_encode().indices.to_numpy()
    starts = np.concatenate([[0], np.nonzero(np.diff(codes))[0] + 1])
    ends = np.concatenate([starts[1:], [len(codes)]])
    names = pc.take(batch.column("block"), pa.array(starts)).to_pylist()
    keys = pc.take(batch.column("key"), pa.array(starts)).to_pylist()
    return zip(names, keys, starts.tolist(), ends.tolist(), strict=True)
