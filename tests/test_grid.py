"""Grid search, single evaluation of the base side, and pruning of stored cells."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from helpers import base_frame, brute, query_frame, rows, same, vectors
from pyspark.sql import functions as F
from test_search import lsh_candidates_by_rule

from vecsearch.operators import common, grid, ivf, kernels, keyed, lsh
from vecsearch.operators.common import arrow_column, evaluated, stored_by, top_n
from vecsearch.operators.exact import knn_exact
from vecsearch.sources.index_store import Index, load_index, save_index


@pytest.mark.parametrize("rows_, queries, dim, cores", [(10**9, 10**6, 64, 1000), (10**9, 5000, 768, 1000), (10**6, 10**7, 128, 64), (50, 3, 8, 8), (0, 0, 1, 4)])
def test_shape_keeps_tasks_bounded(rows_, queries, dim, cores):
    blocks, stripes = grid.shape(rows_, queries, dim, cores)
    assert blocks >= 1 and stripes >= 1
    per_block, per_stripe = -(-queries // blocks), -(-rows_ // stripes)
    assert per_block <= grid.BLOCK_QUERIES and per_block * dim * 8 <= 2 * grid.BLOCK_BYTES and per_stripe <= 2 * grid.STRIPE_ROWS
    assert per_block * per_stripe * dim <= 2 * grid.TASK_WORK
    assert blocks * stripes <= 4 * max(cores, rows_ * queries * dim / grid.TASK_WORK, rows_ / grid.STRIPE_ROWS * blocks) + 4
    if rows_ > 10**6:  # rows / 50,000 blocks of the base would leave so many winners a query
        assert stripes < rows_ / 50_000


def test_winners_grow_with_stripes_not_with_rows(spark):
    x, q = vectors(4000, seed=3), vectors(30, seed=4)
    base, asked = base_frame(spark, x), query_frame(spark, q)
    for blocks, stripes in ((1, 1), (3, 2), (4, 5)):
        found = grid.all_pairs(base, asked, 5, blocks, stripes)
        per_query = {r["query_id"]: r["count"] for r in found.groupBy("query_id").count().collect()}
        assert len(per_query) == 30 and set(per_query.values()) == {5 * stripes}


def test_pilot_bounds_leave_few_winners_and_the_same_rows(spark, monkeypatch):
    monkeypatch.setattr(grid, "PILOT_STRIPES", 8)
    monkeypatch.setattr(grid, "PILOT_SHARE", 4)
    x, q = vectors(1500, seed=5, copies=500), np.concatenate([vectors(20, seed=6), vectors(1500, seed=5)[:1]])
    seen = []
    real = grid.all_pairs
    monkeypatch.setattr(grid, "all_pairs", lambda *a: seen.append(real(*a)) or seen[-1])
    got = knn_exact(base_frame(spark, x), query_frame(spark, q), 6, strategy="blocks", base_block=50)
    same(rows(got), brute(x, q, 6))
    pilot, final = (f.count() for f in seen)
    assert final < 21 * 6 * 30 / 3  # without bounds each of 30 stripes gives every query six rows


@pytest.mark.parametrize("w, blocks", [(8.0, 4), (1.0, 4), (3.0, 100)])
def test_tables_meet_a_pair_in_one_cell_only(spark, w, blocks):
    x, q = vectors(200, seed=7, copies=70), vectors(16, seed=8)
    p = lsh.LshParams(k=4, tables=5, w=w)
    how = {"strategy": "blocks", "base_block": 40, "query_block": blocks}
    got = rows(lsh.search_lsh(base_frame(spark, x, "v"), query_frame(spark, q), 4, p, **how))
    want = brute(x, q, 4, lsh_candidates_by_rule(x, q, 4, p))
    assert {i: [(int(n[1:]), round(d, 9)) for n, d in v] for i, v in got.items()}.keys() == want.keys()
    for i, v in want.items():
        np.testing.assert_allclose([d for _, d in got[i]], [d for _, d in v], atol=1e-9)
    index = lsh.lsh_index(base_frame(spark, x), p)
    probes = lsh.lsh_probes(index, query_frame(spark, q), p).select("query_id", "key")
    pairs = grid.keyed_grid(index, probes, query_frame(spark, q), None, 3, 4, radius=1e9)
    assert pairs.count() == pairs.distinct().count()


def exchanged(df, column):
    """How many exchanges of the plan carry a column of that name."""
    plan = df._jdf.queryExecution().executedPlan()
    found = 0

    def walk(node):
        nonlocal found
        if "ShuffleExchange" in node.getClass().getSimpleName():
            found += any(node.output().apply(i).name() == column for i in range(node.output().size()))
        below = [node.inputPlan()] if "AdaptiveSparkPlan" in node.getClass().getSimpleName() else [node.children().apply(i) for i in range(node.children().size())]
        for child in below:
            walk(child)

    walk(plan)
    return found


def test_vectors_travel_last(spark):
    """Tables and keys are joined on ids; only the join by id and the way to the cell move vectors, however many tables there are."""
    x, q = vectors(300, seed=9), vectors(10, seed=10)
    p = lsh.LshParams(k=4, tables=7, w=4.0)
    index = evaluated(lsh.lsh_index(base_frame(spark, x), p))
    asked = query_frame(spark, q)
    df = grid.keyed_grid(index, lsh.lsh_probes(index, asked, p).select("query_id", "key"), asked, 5, 1, 4)
    assert exchanged(df, "embedding") <= 1 and exchanged(df, "vec") == 1


@pytest.mark.parametrize("how", [{"strategy": "blocks", "base_block": 30, "query_block": 5}, {"strategy": "blocks"}])
def test_base_side_is_evaluated_once(spark, how, tmp_path):
    x, q = vectors(120, seed=11), vectors(12, seed=12)
    calls = spark.sparkContext.accumulator(0)

    @arrow_column("array<string>")
    def keys(ids):
        import pyarrow as pa
        calls.add(len(ids))
        return pa.array([[f"k{i % 3}"] for i in ids.to_pylist()], pa.list_(pa.string()))

    from vecsearch.operators.keyed import search_keyed
    base_frame(spark, x).write.parquet(str(tmp_path / "base"))
    base = spark.read.parquet(str(tmp_path / "base")).withColumn("keys", keys(F.col("id")))
    probes = query_frame(spark, q).select("query_id", F.explode(F.array(F.lit("k0"), F.lit("k2"))).alias("key"))
    got = rows(search_keyed(base, probes, query_frame(spark, q), 4, **how))
    same(got, brute(x, q, 4, [{j for j in range(120) if j % 3 != 1}] * 12))
    assert calls.value == 120


def files_read(df):
    """Files that the scans of a finished plan have opened."""
    total = 0

    def walk(node):
        nonlocal total
        name = node.getClass().getSimpleName()
        if name == "FileSourceScanExec":
            total += node.metrics().apply("numFiles").value()
        below = ([node.executedPlan()] if name == "AdaptiveSparkPlanExec" else [node.plan()] if "QueryStage" in name
                 else [node.children().apply(i) for i in range(node.children().size())])
        for child in below:
            walk(child)

    walk(df._jdf.queryExecution().executedPlan())
    return total


@pytest.fixture(scope="module")
def many_cells(spark, tmp_path_factory):
    x, path = vectors(6000, dim=4, seed=13), str(tmp_path_factory.mktemp("cells") / "index")
    assigned = base_frame(spark, x).withColumn("cell", F.col("id").cast("int")).coalesce(1)
    save_index(Index({"assigned": assigned}), path)
    return x, load_index(spark, path).tables["assigned"]


@pytest.mark.parametrize("strategy", ["scan", "blocks"])
def test_stored_cells_are_pruned_by_a_join(spark, strategy, many_cells):
    (x, stored), probed = many_cells, 5000
    assert stored_by(stored) == ["segment", "cell"] and stored_by(base_frame(spark, x[:3])) == []
    q = vectors(10, dim=4, seed=14)
    asked = query_frame(spark, q)
    probes = asked.crossJoin(spark.range(probed // 10)).select("query_id", (F.col("query_id") * (probed // 10) + F.col("id")).cast("int").alias("cell"))
    from vecsearch.operators.keyed import only_probed
    kept = only_probed(stored, probes.select(F.col("cell").cast("string").alias("key")).distinct(), "cell")
    assert kept.select("id").count() == probed
    kept = kept.select("id", "embedding")
    kept._jdf.queryExecution().executedPlan().executeCollect()
    assert "dynamicpruning" in kept._jdf.queryExecution().executedPlan().toString()
    assert probed <= files_read(kept) <= probed + 10
    got = rows(ivf.search_cells(stored, probes, asked, 3, strategy=strategy))
    same(got, brute(x, q, 3, [set(range(i * 500, i * 500 + 500)) for i in range(10)]))
    none = ivf.search_cells(stored, probes.where("cell < 0"), asked, 3, strategy=strategy)
    assert none.count() == 0


def test_rows_of_many_tables_go_by_blocks_where_keys_are_crowded(spark, monkeypatch):
    """Six blocks of queries and five tables whose rows share few keys: by its keys a row would travel more often."""
    x, q = vectors(200, seed=13), vectors(48, seed=14)
    p, seen = lsh.LshParams(k=4, tables=5, w=8.0), []
    real = keyed.keyed_grid
    monkeypatch.setattr(grid, "BLOCK_QUERIES", 8)
    monkeypatch.setattr(keyed, "keyed_grid", lambda *a, **k: seen.append(a[4]) or real(*a, **k))
    got = rows(lsh.search_lsh(base_frame(spark, x), query_frame(spark, q), 4, p, strategy="blocks"))
    assert seen == [6]
    same(got, brute(x, q, 4, lsh_candidates_by_rule(x, q, 4, p)))


def test_what_travels_by_keys_grows_with_the_input(spark):
    sent = []
    for rows_ in (20_000, 80_000):
        base = spark.range(rows_).select("id", F.array((F.col("id") % 2).cast("string")).alias("keys"))
        asked = spark.createDataFrame([("0", rows_ // 2), ("1", rows_)], "key string, asked bigint")
        sent.append(keyed._travel(base, asked, keyed.BASE_BLOCK_ROWS, keyed.query_rows(rows_ // 2 + rows_, 64, 12))[1])
    assert sent[1] <= 4.2 * sent[0]  # with blocks of 2,000 queries 8.6 times
    assert keyed.query_rows(10**9, 64, 12) * 64 * 8 <= grid.BLOCK_BYTES


def test_first_rows_bound_the_others(monkeypatch):
    """Few pairs are scored twice: the first rows of a task give bounds, so the others need no best of every stretch."""
    x, q, n, pairs = vectors(10_000, seed=15), vectors(2048, seed=16), 10, []
    real = kernels.exact_sq
    monkeypatch.setattr(kernels, "exact_sq", lambda a, b, i, j: pairs.append(len(i)) or real(a, b, i, j))
    asked = grid.Asked(np.arange(len(q)), q, n, kernels.FlatScorer())
    asked.add(np.arange(len(x)), x)
    assert sum(pairs) < 7 * n * len(q)
    want = brute(x, q[:5], n)
    assert {i: asked.best.ids[asked.best.q == i].tolist() for i in range(5)} == {i: [j for j, _ in v] for i, v in want.items()}


@pytest.mark.parametrize("scale", [1e-3, 1.0, 1e6, 1e30])
def test_scores_lose_no_row(scale):
    """Copies, ties and far rows: the product with norms in it must not shut out a row that differences would keep."""
    x = np.concatenate([vectors(700, dim=19, seed=17, copies=30), vectors(300, dim=19, seed=18) + 50]) * scale
    q = np.concatenate([x[:40], vectors(30, dim=19, seed=19) * scale])
    asked = grid.Asked(np.arange(len(q)), q, 7, kernels.FlatScorer())
    for lo in range(0, len(x), 90):
        asked.add(np.arange(lo, min(lo + 90, len(x))), x[lo:lo + 90])
    want = brute(x, q, 7)
    assert {i: asked.best.ids[asked.best.q == i].tolist() for i in range(len(q))} == {i: [j for j, _ in v] for i, v in want.items()}


@pytest.mark.parametrize("shape_", [(3, 5), (4, 16), (1, 7), (2, 0), (30, 64)])
def test_true_places_are_those_of_numpy(shape_):
    keep = np.random.default_rng(20).random(shape_) < 0.3
    assert kernels._true_places(keep).tolist() == np.flatnonzero(keep).tolist()


def crowd(queries, keys, seed):
    """A task whose queries ask for all of ``keys`` keys, and a batch in which each key has many rows."""
    x, q = vectors(keys * 60, seed=seed), vectors(queries, seed=seed + 1)
    probes = {str(k): (np.arange(queries), None) for k in range(keys)}
    lists = pa.array([[str(i % keys)] for i in range(len(x))], pa.list_(pa.string()))
    return x, q, lists, grid.Asked(np.arange(queries), q, 5, kernels.FlatScorer(), probes, None, True)


def test_pairs_behind_many_keys_are_not_held_together(monkeypatch):
    """What the first keys of a batch gave bounds the others, so a task doesn't hold the best rows of every key at once."""
    monkeypatch.setattr(grid, "HELD_PAIRS", 1000, raising=False)
    came, real = [], kernels.BestN.add
    monkeypatch.setattr(kernels.BestN, "add", lambda self, q, d2, ids: came.append(len(q)) or real(self, q, d2, ids))
    x, q, lists, asked = crowd(40, 50, seed=21)
    asked.add(np.arange(len(x)), x, lists)
    assert max(came) < 1000 + 40 * 60 and sum(came) < 40 * 50 * 5  # the best five of every key would be as many
    want = brute(x, q, 5)
    assert {i: asked.best.ids[asked.best.q == i].tolist() for i in range(40)} == {i: [j for j, _ in v] for i, v in want.items()}


def test_distances_of_many_pairs_take_little_memory():
    x = vectors(2000, dim=512, seed=23)
    q, b = np.repeat(np.arange(30), 2000), np.tile(np.arange(2000), 30)
    tracemalloc.start()
    got = kernels.exact_sq(x[:30], x, q, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6  # all pairs at once: 369 MB
    wide = x.astype(np.float64)
    np.testing.assert_allclose(got[:2000], ((wide - wide[0]) ** 2).sum(axis=1), rtol=1e-12)


@pytest.mark.parametrize("prefix", [None, "q"])
def test_keys_travel_in_short_rows(spark, monkeypatch, prefix):
    """A query of 40 keys goes in several rows, its vector in one of them; the task puts them together in whatever order they come."""
    x, q = vectors(80, seed=24), vectors(6, seed=25)
    index = base_frame(spark, x).withColumn("keys", F.array((F.col("id") % 50).cast("string")))
    asked = query_frame(spark, q, prefix)
    probes = asked.select("query_id", F.explode(F.sequence(F.lit(0), F.lit(39)).cast("array<string>")).alias("key"))
    real = grid._search
    with monkeypatch.context() as m:
        m.setattr(grid, "_search", lambda rows_, *a: rows_)
        sent = grid.keyed_grid(index, probes, asked, 3, 2, 2).where("side = 0")
    sizes = sent.groupBy("query_id", "cell").agg(F.max(F.size("keys")).alias("most"), F.sum(F.size("keys")).alias("all"), F.count("vec").alias("vectors")).collect()
    assert len(sizes) == 12 and all(r["most"] <= 16 and r["all"] == 40 and r["vectors"] == 1 for r in sizes)
    monkeypatch.setattr(grid, "_search", lambda rows_, *a: real(rows_.sortWithinPartitions("side", F.rand(1)), *a))
    got = rows(top_n(grid.keyed_grid(index, probes, asked, 3, 2, 2), 3))
    want = brute(x, q, 3, [{j for j in range(80) if j % 50 < 40}] * 6)
    same({int(str(i).removeprefix("q")): v for i, v in got.items()}, want)


def test_blocks_of_queries_follow_their_probes(spark, monkeypatch):
    """Queries that probe many tables go in more blocks, so a task holds a bounded number of probes."""
    x, q = vectors(300, seed=26), vectors(48, seed=27)
    p, seen = lsh.LshParams(k=4, tables=9, w=8.0), []
    probed = lsh.lsh_probes(lsh.lsh_index(base_frame(spark, x), p), query_frame(spark, q), p).count()
    real = keyed.keyed_grid
    monkeypatch.setattr(keyed, "BLOCK_PROBES", probed // 4, raising=False)
    monkeypatch.setattr(keyed, "_travel", lambda *a: (10**6, 10**9))
    monkeypatch.setattr(keyed, "keyed_grid", lambda *a, **k: seen.append(a[4]) or real(*a, **k))
    got = rows(lsh.search_lsh(base_frame(spark, x), query_frame(spark, q), 4, p, strategy="blocks"))
    assert seen[0] >= 4
    same(got, brute(x, q, 4, lsh_candidates_by_rule(x, q, 4, p)))


def test_many_probes_are_not_tried_on_the_driver(spark, monkeypatch, tmp_path):
    x, q = vectors(200, seed=28), vectors(30, seed=29)
    p, tried = lsh.LshParams(k=4, tables=5, w=2.0, fallback=False), []
    query_frame(spark, q).write.parquet(str(tmp_path / "queries"))
    asked = spark.read.parquet(str(tmp_path / "queries"))
    index = evaluated(lsh.lsh_index(base_frame(spark, x), p))
    monkeypatch.setattr(lsh, "DRIVER_PROBES", 1000, raising=False)
    real = common.fetch_if_small
    monkeypatch.setattr(common, "fetch_if_small", lambda df, most: tried.append(df.columns) or real(df, most))
    few = lsh.lsh_candidates(index, asked.where("query_id < 3"), 4, p)
    assert ["query_id", "tbl", "key", "members"] in tried
    tried.clear()
    many = lsh.lsh_candidates(index, asked, 4, p)
    assert ["query_id", "tbl", "key", "members"] not in tried
    assert {tuple(r) for r in few.collect()} == {tuple(r) for r in many.where("query_id < 3").collect()} != set()
