import numpy as np
import pytest
from helpers import base_frame, brute, query_frame, rows, same, vectors
from pyspark.sql import functions as F

from vecsearch.functions.hashing import hash_params
from vecsearch.operators import hypercube, ivf, learned, lsh, pq
from vecsearch.operators.exact import knn_exact, knn_self
from vecsearch.operators.keyed import search_keyed

BLOCKS = {"strategy": "blocks", "base_block": 9, "query_block": 4}


@pytest.fixture(scope="module")
def data():
    return vectors(150, seed=1, copies=50), vectors(12, seed=2)


@pytest.mark.parametrize("how", [{}, BLOCKS])
def test_exact(spark, data, how):
    x, q = data
    got = knn_exact(base_frame(spark, x), query_frame(spark, q), 7, **how)
    same(rows(got), brute(x, q, 7))


@pytest.mark.parametrize("how", [{}, BLOCKS])
def test_exact_string_ids_and_copies(spark, data, how):
    """A third of the base is one vector: ties are cut by id, compared as text."""
    x, _ = data
    near_copy = x[:1] + np.float32(0.01)
    got = rows(knn_exact(base_frame(spark, x, "p"), query_frame(spark, near_copy, "q"), 60, **how))
    assert len(got["q0"]) == 60
    tied = [i for i, _ in got["q0"]][:51]
    assert tied == sorted(["p0"] + [f"p{i}" for i in range(100, 150)])


def test_self_join_keeps_copies(spark, data):
    x, _ = data
    got = knn_self(base_frame(spark, x), 3).collect()
    assert len(got) == 3 * len(x) and all(r["src"] != r["dst"] for r in got)
    first = sorted((r["rank"], r["dst"], r["distance"]) for r in got if r["src"] == 0)
    assert first == [(1, 100, 0.0), (2, 101, 0.0), (3, 102, 0.0)]


def lsh_candidates_by_rule(x, q, n, p):
    """The candidate rule followed step by step on plain Python sets."""
    tables = []
    params = hash_params(x.shape[1], p.k, p.tables, p.w, p.seed)

    def code(v, h):
        return tuple(np.floor((h.v @ v.astype(np.float64) + h.t) / p.w).astype(int))

    for h in params:
        buckets = {}
        for i, v in enumerate(x):
            buckets.setdefault(code(v, h), []).append(i)
        tables.append(buckets)
    out = []
    for v in q:
        found = set()
        for h, buckets in zip(params, tables):
            own = code(v, h)
            for key, members in buckets.items():
                delta = [abs(a - b) for a, b in zip(own, key)]
                if sum(d > 0 for d in delta) <= 1 and max(delta) <= p.radius:
                    found.update(members)
        if p.fallback and len(found) < 2 * n:
            for buckets in tables[:p.tables // 2]:
                for members in buckets.values():
                    found.update(members)
                    if len(found) >= 10 * n:
                        break
        out.append(found)
    return out


@pytest.mark.parametrize("w,n,tables", [(8.0, 3, 5), (2.0, 3, 5), (1.0, 2, 5), (1.0, 30, 4), (0.5, 5, 1), (3.0, 4, 6)])
@pytest.mark.parametrize("how", [{}, BLOCKS])
def test_lsh(spark, data, w, n, tables, how):
    x, q = data
    p = lsh.LshParams(k=4, tables=tables, w=w, radius=1)
    got = rows(lsh.search_lsh(base_frame(spark, x), query_frame(spark, q), n, p, **how))
    same(got, brute(x, q, n, lsh_candidates_by_rule(x, q, n, p)))


def test_lsh_radius_two(spark, data):
    x, q = data
    p = lsh.LshParams(k=4, tables=3, w=1.5, radius=2, fallback=False)
    got = rows(lsh.search_lsh(base_frame(spark, x), query_frame(spark, q), 5, p))
    same(got, brute(x, q, 5, lsh_candidates_by_rule(x, q, 5, p)))


def cube_candidates_by_rule(x, q, p):
    h = hash_params(x.shape[1], p.k, 1, p.w, p.seed)[0]

    def vertex(v):
        bits = np.floor((h.v @ v.astype(np.float64) + h.t) / p.w).astype(int) % 2
        return int("".join(map(str, bits)), 2)

    members = {}
    for i, v in enumerate(x):
        members.setdefault(vertex(v), []).append(i)
    out = []
    for v in q:
        found = []
        for mask in hypercube.probe_masks(p.k, p.probes):
            found += members.get(vertex(v) ^ mask, [])
        found = found[:p.max_checked]
        out.append(set(found or range(len(x))))
    return out


@pytest.mark.parametrize("p", [
    hypercube.CubeParams(k=4, probes=3, w=2.0), hypercube.CubeParams(k=4, probes=5, w=2.0, max_checked=7),
    hypercube.CubeParams(k=9, probes=1, w=1.0), hypercube.CubeParams(k=4, probes=3, max_checked=0),
    hypercube.CubeParams(k=4, probes=16, w=2.0)])
@pytest.mark.parametrize("how", [{}, BLOCKS])
def test_hypercube(spark, data, p, how):
    x, q = data
    got = rows(hypercube.search_hypercube(base_frame(spark, x), query_frame(spark, q), 6, p, **how))
    same(got, brute(x, q, 6, cube_candidates_by_rule(x, q, p)))
    if p.probes == 16:
        same(got, brute(x, q, 6))


def test_probe_order():
    assert hypercube.probe_masks(3, 8) == [0, 4, 2, 1, 6, 5, 3, 7]
    assert hypercube.probe_masks(3, 2) == [0, 4]


@pytest.fixture(scope="module")
def index(spark, data):
    x, q = data
    base = base_frame(spark, x).cache()
    centres = ivf.kmeans(base, 6, restarts=2).cache()
    return base, query_frame(spark, q), centres


@pytest.mark.parametrize("how", [{}, BLOCKS])
def test_ivf_reads_everything_with_all_cells(index, data, how):
    base, queries, centres = index
    got = ivf.search_ivfflat(base, queries, 7, ivf.IvfParams(nprobe=6), centres, **how)
    same(rows(got), brute(*data, 7))


@pytest.mark.parametrize("how", [{}, BLOCKS])
def test_range_search_is_inclusive(index, data, how):
    base, queries, centres = index
    x, q = data
    all_near = brute(x, q, len(x))
    radius = all_near[0][10][1]
    got = {}
    for r in ivf.range_search(ivf.assign_nearest(base, centres), centres, queries, radius, 6, **how).collect():
        got.setdefault(r["query_id"], set()).add(r["neighbor_id"])
    want = {i: {j for j, d in near if d <= radius} for i, near in all_near.items()}
    assert got == {i: s for i, s in want.items() if s} and len(got[0]) >= 11


def test_assignment_and_lloyd(index, data):
    base, _, centres = index
    x, _ = data
    c = np.array([r["centroid"] for r in centres.orderBy("cell").collect()])
    cost = ((x[:, None, :].astype(float) - c[None]) ** 2).sum(2)
    cells = {r["id"]: r["cell"] for r in ivf.assign_nearest(base, centres).collect()}
    assert [cells[i] for i in range(len(x))] == cost.argmin(1).tolist()
    moved = np.array([r["centroid"] for r in ivf.lloyd_step(base, centres).orderBy("cell").collect()])
    after = ((x[:, None, :].astype(float) - moved[None]) ** 2).sum(2).min(1).sum()
    assert after <= cost.min(1).sum() + 1e-9


def test_ties_take_the_lowest_cell_and_empty_cells_stay(spark):
    base = base_frame(spark, np.array([[0.0, 0.0], [4.0, 0.0]], dtype=np.float32))
    centres = spark.createDataFrame([(0, [9.0, 9.0]), (2, [1.0, 0.0]), (1, [-1.0, 0.0])], "cell int, centroid array<double>")
    assert {r["id"]: r["cell"] for r in ivf.assign_nearest(base, centres).collect()} == {0: 1, 1: 2}
    assert {r["cell"]: r["centroid"] for r in ivf.lloyd_step(base, centres).collect()} == {
        0: [9.0, 9.0], 1: [0.0, 0.0], 2: [4.0, 0.0]}


def test_large_centroid_table_takes_the_block_path(spark, index, monkeypatch):
    base, queries, centres = index
    want = {r["query_id"]: r["cells"] for r in ivf.nearest_cells(queries, "query_id", "query_vec", centres, 3).collect()}
    monkeypatch.setattr(ivf, "SMALL_CENTROID_ROWS", 2)
    got = {r["query_id"]: r["cells"] for r in ivf.nearest_cells(queries, "query_id", "query_vec", centres, 3).collect()}
    assert got == want


def reconstruction_error(base, centres, m, sizes):
    res = pq.residuals(ivf.assign_nearest(base, centres), centres).cache()
    out = []
    for size in sizes:
        sub = 8 // m
        first = pq.split_subvectors(res.where(F.col("id") < size), m, sub).select(
            "m", F.col("id").cast("int").alias("code"), F.col("sub").alias("centroid"))
        codes = pq.pq_encode(res, first)
        book = {(r["m"], r["code"]): r["centroid"] for r in first.collect()}
        total = 0.0
        for r in res.join(codes.select("id", "codes"), "id").collect():
            back = np.concatenate([book[j, c] for j, c in enumerate(r["codes"])])
            total += ((np.array(r["residual"]) - back) ** 2).sum()
        out.append(total)
    return out


def test_more_codes_fit_better(index):
    base, _, centres = index
    few, many = reconstruction_error(base, centres, 2, (8, 64))
    assert many < few


@pytest.mark.parametrize("how", [{}, BLOCKS])
def test_pq_distance_by_hand(spark, index, data, how):
    base, queries, centres = index
    x, q = data
    res = pq.residuals(ivf.assign_nearest(base, centres), centres)
    book = pq.pq_train(res, m=2, restarts=1, max_iter=3).cache()
    assert {r["m"]: r["n"] for r in book.groupBy("m").agg(F.count("*").alias("n")).collect()} == {0: 16, 1: 16}
    codes = pq.pq_encode(res, book).cache()
    got = rows(pq.search_ivfpq(base, queries, 200, pq.PqParams(nprobe=6), centres, book, codes, **how))
    c = {r["cell"]: np.array(r["centroid"]) for r in centres.collect()}
    b = {(r["m"], r["code"]): np.array(r["centroid"]) for r in book.collect()}
    coded = {r["id"]: (r["cell"], r["codes"]) for r in codes.collect()}
    for i in (0, 5):
        want = []
        for j, (cell, code) in coded.items():
            left = q[i].astype(float) - c[cell]
            want.append((np.sqrt(sum(((left[4 * m:4 * m + 4] - b[m, k]) ** 2).sum() for m, k in enumerate(code))), j))
        want = sorted(want)
        np.testing.assert_allclose([d for _, d in got[i]], [d for d, _ in want], atol=1e-9)
        assert {j for j, _ in got[i]} == {j for _, j in want}


def test_pq_sizes():
    assert [pq.fit_m(64, m) for m in (8, 7, 100)] == [8, 4, 64]
    assert pq.fit_m(7, 3) == 1
    assert [pq.codes_for(s) for s in (4, 9, 10, 19, 20)] == [16, 16, 64, 64, 256]
    assert pq.codes_for(20, 40) == 40
    with pytest.raises(ValueError):
        pq.codes_for(3)
    assert [pq.coarse_cells(100, n) for n in (5, 50, 5000)] == [2, 5, 100]


def test_subvector_tail_is_padded(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "id int, residual array<double>")
    got = [(r["m"], r["sub"]) for r in pq.split_subvectors(df, 2, 2).orderBy("m").collect()]
    assert got == [(0, [1.0, 2.0]), (1, [3.0, 0.0])]


def test_learned_with_all_partitions_is_exact(index, data):
    base, queries, centres = index
    labelled = learned.partition_labels(base, centres).cache()
    model, quality = learned.train_partition_model(labelled, epochs=5)
    row = quality.first()
    assert row["train_loss"] > 0 and 0 <= row["val_accuracy"] <= 100
    scores = learned.predict_scores(model, queries)
    sums = scores.groupBy("query_id").agg(F.sum("prob").alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-6 for r in sums)
    got = learned.search_learned(base, queries, 7, learned.LearnedParams(probes=6), labelled=labelled, model=model)
    same(rows(got), brute(*data, 7))


def test_labels_are_dense(spark):
    base = base_frame(spark, np.array([[0.0], [5.0]], dtype=np.float32))
    centres = spark.createDataFrame([(3, [0.0]), (4, [99.0]), (7, [5.0])], "cell int, centroid array<double>")
    assert {r["id"]: r["part"] for r in learned.partition_labels(base, centres).collect()} == {0: 0, 1: 1}


def test_no_candidates_give_no_rows(spark, data):
    x, q = data
    base = base_frame(spark, x).withColumn("keys", F.array(F.lit("a")))
    queries = query_frame(spark, q)
    probes = queries.select("query_id", F.lit("b").alias("key"))
    for how in ({}, BLOCKS):
        assert search_keyed(base, probes, queries, 3, **how).count() == 0


def test_scan_refuses_a_large_query_side(spark, data, monkeypatch):
    from vecsearch.operators import keyed
    x, q = data
    monkeypatch.setattr(keyed, "SMALL_QUERY_ROWS", 5)
    base, queries = base_frame(spark, x), query_frame(spark, q)
    with pytest.raises(ValueError):
        knn_exact(base, queries, 3, strategy="scan")
    same(rows(knn_exact(base, queries, 3)), brute(x, q, 3))


def test_ragged_vectors_are_refused(spark):
    base = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "id bigint, embedding array<float>")
    queries = spark.createDataFrame([(1, [1.0, 2.0])], "query_id bigint, query_vec array<float>")
    with pytest.raises(Exception, match="common length"):
        knn_exact(base, queries, 1).collect()


@pytest.mark.parametrize("strategy", ["scan", "blocks"])
def test_very_long_vectors_are_all_found(spark, strategy):
    """Squares beyond 4-byte floats neither vanish nor lose their order."""
    x = np.array([[k * 1e20, 0.0] for k in range(5)])
    base = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, embedding array<double>")
    asked = spark.createDataFrame([(0, x[0].tolist())], "query_id bigint, query_vec array<double>")
    got = rows(knn_exact(base, asked, 4, strategy=strategy))
    assert [i for i, _ in got[0]] == [0, 1, 2, 3]


@pytest.mark.parametrize("bad", [float("nan"), float("inf")])
def test_elements_that_are_no_numbers_are_refused(spark, bad):
    base = spark.createDataFrame([(0, [1.0, bad]), (1, [0.0, 1.0])], "id bigint, embedding array<double>")
    asked = spark.createDataFrame([(0, [0.0, 0.0])], "query_id bigint, query_vec array<double>")
    with pytest.raises(Exception, match="finite"):
        knn_exact(base, asked, 2).collect()


@pytest.mark.parametrize("strategy", ["scan", "blocks"])
def test_repeated_query_ids_are_refused(spark, strategy):
    base = base_frame(spark, vectors(20))
    asked = query_frame(spark, vectors(2)).withColumn("query_id", F.lit(1).cast("bigint"))
    with pytest.raises(Exception, match="unique"):
        knn_exact(base, asked, 2, strategy=strategy).collect()


def test_quantised_search_above_the_centroid_limit_is_the_same(spark, monkeypatch):
    x, q = vectors(400, 16, 1), vectors(30, 16, 2)
    base, asked = base_frame(spark, x), query_frame(spark, q)
    cells = ivf.kmeans(base, 12, seed=1, max_iter=5)
    res = pq.residuals(ivf.assign_nearest(base, cells), cells)
    book = pq.pq_train(res, m=4, restarts=1, max_iter=5)
    codes = pq.pq_encode(res, book)
    probes = ivf.probe_cells(asked, cells, 4)
    want = rows(pq.adc_distances(codes, probes, asked, cells, book, 6))
    monkeypatch.setattr(pq, "SMALL_CENTROID_ROWS", 5)
    same(rows(pq.adc_distances(codes, probes, asked, cells, book, 6)), want)


def test_probable_partitions_equal_ranked_rows(spark):
    base = base_frame(spark, vectors(300, 6, 3))
    labelled = base.withColumn("part", (F.col("id") % 5).cast("int"))
    model, _ = learned.train_partition_model(labelled, epochs=3)
    asked = query_frame(spark, vectors(40, 6, 4))
    ranked = learned.top_partitions(learned.predict_scores(model, asked), 3)
    key = lambda df: sorted((r.query_id, r["rank"], r.part, round(r.prob, 12)) for r in df.collect())
    assert key(learned.probable_partitions(model, asked, 3)) == key(ranked)


def test_stored_learned_index_gives_the_same_neighbours(spark, tmp_path):
    base, asked = base_frame(spark, vectors(300, 6, 3)), query_frame(spark, vectors(40, 6, 4))
    labelled = base.withColumn("part", (F.col("id") % 5).cast("int"))
    model, _ = learned.train_partition_model(labelled, epochs=3)
    learned.save_learned(str(tmp_path / "learned"), model, labelled)
    again, stored = learned.load_learned(spark, str(tmp_path / "learned"))
    p = learned.LearnedParams(probes=2)
    want = rows(learned.search_learned(base, asked, 5, p, labelled=labelled, model=model))
    same(rows(learned.search_learned(base, asked, 5, p, labelled=stored, model=again)), want)


@pytest.mark.parametrize("how", ["blobs", "even"])
def test_tree_of_centroids_finds_the_same_cells(spark, monkeypatch, how):
    rng = np.random.default_rng(5)
    c = rng.normal(size=(300, 6)) if how == "even" else (rng.normal(size=(10, 1, 6)) * 9 + rng.normal(size=(1, 30, 6)) * 0.2).reshape(300, 6)
    c[290:] = c[3]  # ties go to the lowest cell
    cells = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(c)], "cell int, centroid array<double>")
    x = (c[rng.integers(0, 300, 120)] + rng.normal(size=(120, 6)) * 0.3).astype(np.float32)
    base = base_frame(spark, x)
    want = {r.id: list(r.cells) for r in ivf.nearest_cells(base, "id", "embedding", cells, 7).collect()}
    monkeypatch.setattr(ivf, "SMALL_CENTROID_ROWS", 40)
    got = {r.id: list(r.cells) for r in ivf.nearest_cells(base, "id", "embedding", cells, 7).collect()}
    assert got == want
    all_of_them = {r.id: len(r.cells) for r in ivf.nearest_cells(base.limit(3), "id", "embedding", cells, 300).collect()}
    assert set(all_of_them.values()) == {300}
    monkeypatch.setattr(ivf, "SMALL_CENTROID_ROWS", 10**6)
    assert {r.id: r.cell for r in ivf.assign_nearest(base, cells).collect()} == {i: v[0] for i, v in want.items()}


def test_large_results_are_settled_in_one_evaluation(spark):
    from vecsearch.operators.common import settle

    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    kept = settle(spark.range(1_500_000).mapInArrow(count, "id long"))
    assert kept.count() == 1_500_000
    assert passed.value == 1_500_000
