"""Whitening against dense linear algebra."""

import numpy as np
import pytest

from vecsearch.llm.queries import QUERIES
from vecsearch.llm.whitening import jacobi_davidson, lattice, minres, total, whiten

FOLDER = "/root/testdata/sf0.001"
WIDE = "vec_id long, embedding array<float>, n long, component int, x string, d string, ids string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x", "d", "ids") for i, v in rows], WIDE)


def dense(vectors, k=32):
    x = np.floor(np.asarray(vectors, np.float64) * 64) + 1_000_000
    z = x - x.mean(axis=0)
    values, u = np.linalg.eigh(z.T @ z / len(z))
    return x, values[::-1][:k], u[:, ::-1][:, :k], z


def check(df, ids, vectors, k=32):
    x, values, u, z = dense(vectors, k)
    n, got = len(x), df.toPandas()
    assert len(got) == n * len(values) and (got.n == n).all()
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[list(ids)].to_numpy()
    want = z @ u / np.sqrt(values)
    assert list(sorted(got.component.unique())) == list(range(1, len(values) + 1))
    sign = np.sign((wide * want).sum(axis=0))
    np.testing.assert_allclose(wide, want * sign, atol=1e-8)
    np.testing.assert_allclose(np.cov(wide.T, bias=True).reshape(len(values), -1), np.eye(len(values)), atol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error.max() < 1e-9
    share = got.drop_duplicates("component").sort_values("component").explained.to_numpy()
    np.testing.assert_allclose(share, values / (z ** 2).sum() * n, rtol=1e-9)
    sums = x.astype(int).sum(axis=0)
    far = {i: int(((n * row.astype(int) - sums) ** 2).sum()) for i, row in zip(ids, x)}
    assert all(far[i] == v for i, v in zip(got.vec_id, got.deviation))


def test_query_equals_dense(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()
    check(QUERIES["op13_whitening"](spark, FOLDER), [r[0] for r in rows], [r[1] for r in rows])


def test_hot_vector_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = rng.normal(size=(300, 6)).astype(np.float32)
    good[:100] = good[0]
    rows = [(i, v.tolist()) for i, v in enumerate(good)]
    odd = [(1000, None), (1001, []), (1002, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (1003, [float("nan")] * 6), (1004, [float("inf")] + [0.0] * 5),
           (1005, [1.0, 2.0])]
    check(whiten(frame(spark, rows + odd).repartition(7)), range(300), good, 6)
    check(whiten(frame(spark, rows + odd), components=2), range(300), good, 2)


def test_repeated_missing_and_great_values(spark):
    rows = [(None, [1.0, 2.0]), (7, [3.0, 5.0]), (7, [3.0, 5.0]), (8, [2.0, 9.0])]
    got = whiten(frame(spark, rows)).toPandas()
    assert len(got) == 8 and got.vec_id.isna().sum() == 2 and (got.vec_id == 7).sum() == 4 and (got.n == 4).all()
    huge = whiten(frame(spark, [(i, [1e30 * (i + 1), float(i % 2)]) for i in range(5)])).toPandas()
    assert len(huge) == 5 and huge.deviation.isna().all() and huge.identity_error.max() < 1e-9
    far = whiten(frame(spark, [(i, [1e8 * i, 0.0]) for i in range(4)])).toPandas().set_index("vec_id").deviation
    x = [int(np.floor(64 * np.float64(np.float32(1e8 * i)))) for i in range(4)]
    assert [None if np.isnan(v) else int(v) for v in far.loc[range(4)]] == [
        v if v < 2**63 else None for v in ((4 * a - sum(x)) ** 2 for a in x)]


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_no_variance_gives_no_row(spark, rows):
    df = whiten(frame(spark, rows))
    assert df.columns[:2] == ["vec_id", "component"] and df.count() == 0


def test_rank_below_components(spark):
    rng = np.random.default_rng(5)
    flat = np.round(rng.normal(size=(60, 2)) * 4)
    rows = [(i, [*v.tolist(), *v.tolist(), 1.0]) for i, v in enumerate(flat)]
    got = whiten(frame(spark, rows)).toPandas()
    assert sorted(got.component.unique()) == [1, 2] and got.identity_error.max() < 1e-9


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(0)
    a = rng.normal(size=(30, 30))
    a = a + a.T
    b = rng.normal(size=(30, 3))
    assert np.abs(a @ minres(lambda v: a @ v, b, 60) - b).max() < 1e-9
    assert (minres(lambda v: a @ v, np.zeros((30, 2)), 5) == 0).all()


@pytest.mark.parametrize("d, k, values", [
    (64, 32, 60 + np.arange(64) * 0.1), (200, 10, 1 / (1.0 + np.arange(200))), (300, 32, 1 + np.random.default_rng(1).random(300) / 2),
    (5, 32, np.arange(5.0) + 1), (64, 32, np.repeat([5.0, 3.0], 32)), (40, 8, np.where(np.arange(40) < 5, 2.0, 0.0))])
def test_pairs_of_known_spectra(d, k, values):
    q = np.linalg.qr(np.random.default_rng(2).normal(size=(d, d)))[0]
    a = (q * values) @ q.T
    a, k = (a + a.T) / 2, min(k, d)
    widest = []

    def product(columns):
        widest.append(columns.shape[1])
        return a @ columns

    found, u = jacobi_davidson(product, d, k)
    limit = 1e-13 * d * values.max()
    np.testing.assert_allclose(found, np.sort(values)[::-1][:k], atol=limit)
    assert np.abs(a @ u - u * found).max() < limit and np.abs(u.T @ u - np.eye(k)).max() < 1e-12
    assert max(widest) <= k + 8


def test_blocks_hold_every_row(spark):
    rng = np.random.default_rng(9)
    v = rng.normal(size=(9000, 3))
    packed = lattice(frame(spark, [(i, x.tolist()) for i, x in enumerate(v)]).coalesce(1))
    assert packed.df.selectExpr("sum(rows)", "max(rows)").first()[0] == 9000
    want = (np.floor(v.astype(np.float32).astype(np.float64) * 64) + 1_000_000).sum(axis=0)
    assert (total(packed.df, 3, 3, lambda x: x.astype(np.int64).sum(axis=0), "long") == want).all()
    packed.drop()
