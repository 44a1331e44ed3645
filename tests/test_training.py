"""k-means problems trained together."""

import numpy as np
import pytest
from helpers import base_frame, vectors

from vecsearch.operators import ivf, lloyd, pq


def blobs(k, per, dim=6, seed=0, hot=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(k, dim)) * 20
    x = (centres[:, None] + rng.normal(size=(k, per, dim)) * 0.1).reshape(-1, dim)
    return centres, np.concatenate([x, np.repeat(x[:1], hot, axis=0)]).astype(np.float32)


def plain_step(x, centres):
    label, square = lloyd.nearest(x, centres)
    return np.array([x[label == j].mean(axis=0) if (label == j).any() else centres[j] for j in range(len(centres))]), square.sum()


def test_every_blob_gets_a_centre(spark):
    centres, x = blobs(12, 25, hot=150)
    got = np.array([r.centroid for r in ivf.kmeans(base_frame(spark, x).repartition(5), 12, seed=3, restarts=3).collect()])
    assert np.abs(got[:, None] - centres[None]).max(axis=2).min(axis=0).max() < 0.2


def test_runs_from_given_starts_equal_plain_steps(spark):
    x = vectors(400, dim=8, seed=5).astype(np.float64)
    slices, starts = [(0, 4), (4, 8)], [x[:7, :4], x[20:27, 4:]]
    found = lloyd.train(base_frame(spark, x.astype(np.float32)), slices, 7, 0, 1, 3, starts=starts)
    x = x.astype(np.float32).astype(np.float64)
    for (lo, hi), start, p in zip(slices, starts, found):
        want = start
        for _ in range(3):
            want, cost = plain_step(x[:, lo:hi], want)
        np.testing.assert_allclose(p.centres, want, atol=1e-9)
        assert p.cost == pytest.approx(cost)


def test_coincident_starts_end_without_an_empty_cell(spark):
    _, x = blobs(6, 30, dim=4, seed=2)
    base = base_frame(spark, x)
    problem = lloyd.train(base, [(0, 4)], 6, 0, 1, 50, starts=[np.repeat(x[:1], 6, axis=0)])[0]
    n = np.bincount(lloyd.nearest(x.astype(np.float64), problem.centres)[0], minlength=6)
    assert (n > 0).all() and problem.resting


def test_fewer_distinct_rows_than_cells(spark):
    x = np.repeat(vectors(3, dim=4, seed=1), 40, axis=0)
    got = np.array([r.centroid for r in ivf.kmeans(base_frame(spark, x), 5, restarts=2).collect()])
    apart = np.abs(got[:, None] - x[::40][None]).max(axis=2)
    assert len(got) == 5 and apart.min(axis=1).max() < 1e-9 and apart.min(axis=0).max() < 1e-9
    with pytest.raises(ValueError):
        lloyd.train(base_frame(spark, x).limit(0), [(0, 4)], 2, 0, 1, 5)


def test_one_scan_per_step_for_all_problems(spark, monkeypatch):
    passes = []
    real = lloyd.Trainer._pass
    monkeypatch.setattr(lloyd.Trainer, "_pass", lambda self, problems, *a: passes.append(len(problems)) or real(self, problems, *a))
    x = vectors(300, dim=16, seed=8)
    found = lloyd.train(base_frame(spark, x), [(0, 4), (4, 8), (8, 12), (12, 16)], 5, 1, 3, 4)
    assert len(found) == 4 and max(passes) == 12 and len(passes) <= 2 + lloyd.START_ROUNDS + 4 + 12
    costs = [plain_step(x[:, p.lo:p.hi].astype(np.float64), p.centres)[1] for p in found]
    alone = [lloyd.train(base_frame(spark, x), [(p.lo, p.hi)], 5, 1, 3, 4)[0] for p in found]
    np.testing.assert_allclose(costs, [plain_step(x[:, p.lo:p.hi].astype(np.float64), p.centres)[1] for p in alone])
    monkeypatch.setattr(lloyd, "SUM_BYTES", 1)  # problems that don't fit together come to the same
    passes.clear()
    apart = lloyd.train(base_frame(spark, x), [(p.lo, p.hi) for p in found], 5, 1, 3, 4)
    assert max(passes) == 1
    np.testing.assert_allclose([p.cost for p in apart], [p.cost for p in found])


def test_partitions_make_no_difference(spark):
    x = vectors(500, dim=4, seed=9, copies=200)
    a, b = (lloyd.train(base_frame(spark, x).repartition(n), [(0, 4)], 8, 2, 2, 30)[0] for n in (1, 9))
    np.testing.assert_allclose(a.centres, b.centres, atol=1e-9)


def test_codebook_of_a_seeded_run_is_made_of_means(spark):
    x = vectors(500, dim=8, seed=4)
    res = base_frame(spark, x).withColumnRenamed("embedding", "residual").selectExpr("id", "1 as cell", "cast(residual as array<double>) residual")
    book = pq.pq_train(res, m=2, restarts=2).collect()
    assert {(r.m, r.code) for r in book} == {(m, c) for m in range(2) for c in range(16)}
    for m in range(2):
        centres = np.array([r.centroid for r in sorted(book, key=lambda r: r.code) if r.m == m])
        part = x[:, 4 * m:4 * m + 4].astype(np.float64)
        np.testing.assert_allclose(plain_step(part, centres)[0], centres, atol=1e-4)
        assert len(set(lloyd.nearest(part, centres)[0])) == 16


def test_nearest_and_sums_are_the_same_in_any_blocks(monkeypatch):
    rng = np.random.default_rng(8)
    x, centres = rng.normal(size=(500, 6)), rng.normal(size=(30, 6))
    monkeypatch.setattr(lloyd, "CACHED_CELLS", 200)
    label, square = lloyd.nearest(x, centres)
    every = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (label == every.argmin(axis=1)).all() and np.allclose(square, every.min(axis=1))
    for shift in (0, 70_000):  # labels beyond short integers too
        hit, n, total = lloyd.grouped_sums(x, label + shift)
        assert hit.tolist() == sorted(set((label + shift).tolist())) and n.tolist() == np.bincount(label)[hit - shift].tolist()
        assert np.allclose(total, [x[label == h - shift].sum(axis=0) for h in hit])
