"""Small seeded data and brute-force answers."""

import numpy as np


def vectors(n, dim=8, seed=0, copies=0):
    """Random vectors; the last ``copies`` rows repeat the first one."""
    x = np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32)
    if copies:
        x[-copies:] = x[0]
    return x


def base_frame(spark, x, prefix=None):
    ids = [i if prefix is None else f"{prefix}{i}" for i in range(len(x))]
    kind = "bigint" if prefix is None else "string"
    return spark.createDataFrame(list(zip(ids, x.tolist())), f"id {kind}, embedding array<float>")


def query_frame(spark, x, prefix=None):
    return base_frame(spark, x, prefix).withColumnsRenamed({"id": "query_id", "embedding": "query_vec"})


def rows(df):
    """{query: [(neighbor, distance)] by rank}."""
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["neighbor_id"], r["distance"]))
    return out


def brute(x, q, n, candidates=None):
    """Top n per query by (distance, id) over all rows or the given candidate sets."""
    out = {}
    for i, v in enumerate(q.astype(np.float64)):
        pool = range(len(x)) if candidates is None else sorted(candidates[i])
        dist = [(float(np.sqrt(((x[j].astype(np.float64) - v) ** 2).sum())), j) for j in pool]
        if dist:
            out[i] = [(j, d) for d, j in sorted(dist)[:n]]
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for key, expected in want.items():
        assert [i for i, _ in got[key]] == [i for i, _ in expected], key
        np.testing.assert_allclose([d for _, d in got[key]], [d for _, d in expected], atol=1e-9)
