"""M2: partial fits against plain numpy, and centroid tables of any size."""

import hashlib

import numpy as np
import pytest

from ledgerlink.operators import clusters as CL


def frame(spark, x, ids=None):
    return spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids if ids is not None else range(len(x)), x)], "id long, v array<double>")


def nearest(x, c):
    d = ((x[:, None, :] - c[None, :, :]) ** 2).sum(-1)
    return np.array([np.lexsort((np.arange(len(c)), np.round(r, 9)))[0] for r in d]), d


def plain(x, ids, k, rows):
    order = np.argsort(ids)
    c = x[[i for i in sorted(range(len(x)), key=lambda i: hashlib.md5(str(ids[i]).encode()).hexdigest())[:k]]].copy()
    n = np.zeros(len(c), dtype=int)
    for a in range(0, len(x), rows):
        b = x[order[a:a + rows]]
        at, _ = nearest(b, c)
        for j in np.unique(at):
            m = (at == j).sum()
            c[j] = (c[j] * n[j] + b[at == j].sum(0)) / (n[j] + m)
            n[j] += m
    return c, n


@pytest.mark.parametrize("rows,most,real", [(50, 64, 50), (10_000, 64, 10_000), (10, 4, 75)])
def test_partial_fits_equal_plain_ones(spark, rows, most, real):
    rng = np.random.RandomState(1)
    x, ids = rng.randn(300, 6), rng.permutation(1000)[:300]
    a, cents = CL.minibatch_fit(frame(spark, x, ids), "id", "v", 7, block_rows=rows, max_blocks=most)
    c, n = plain(x, ids, 7, real)
    got = {r.cluster: (r.n, r["_c"]) for r in cents.collect()}
    assert sorted(got) == list(range(7)) and sum(n) == 300
    for j in range(7):
        assert got[j][0] == n[j] and np.allclose(got[j][1], c[j])
    at, d = nearest(x, c)
    assert {r.id: r.cluster for r in a.collect()} == dict(zip(ids.tolist(), at.tolist()))


def test_named_start_and_rows_without_vectors(spark):
    x = np.array([[0.0], [1.0], [10.0], [11.0]])
    df = frame(spark, x).union(spark.createDataFrame([(9, None)], "id long, v array<double>"))
    start = spark.createDataFrame([(5, [0.0]), (6, [19.0]), (7, [1e6])], "cluster long, _c array<double>")
    a, cents = CL.minibatch_fit(df, "id", "v", 3, start=start)
    assert {r.cluster: (r.n, r["_c"]) for r in cents.collect()} == {5: (2, [0.5]), 6: (2, [10.5]), 7: (0, [1e6])}
    assert {r.id: (r.cluster, r.sqdist) for r in a.collect()} == {0: (5, 0.25), 1: (5, 0.25), 2: (6, 0.25), 3: (6, 0.25)}
    assert CL.minibatch_fit(df.limit(0), "id", "v", 3)[0].count() == 0


def test_more_centroids_than_one_block(spark, monkeypatch):
    monkeypatch.setattr(CL, "CENTROID_BLOCK", 16)
    monkeypatch.setattr(CL, "PART_ROWS", 40)
    rng = np.random.RandomState(2)
    x, c = rng.randint(-4, 5, (150, 3)).astype(float), rng.randint(-4, 5, (100, 3)).astype(float)
    rows = frame(spark, x).withColumnRenamed("v", "_v")
    cents = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(c)], "cluster long, _c array<double>")
    got = {r.id: (r.cluster, r.sqdist) for r in CL.nearest_centroids(rows, cents).collect()}
    at, d = nearest(x, c)
    assert got == {i: (int(j), float(d[i, j])) for i, j in enumerate(at)}
