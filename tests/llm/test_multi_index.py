import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlink.llm import multi_index as M


def brute(ids, x, k=20):
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        s = (x * x[i]).sum(axis=1)
        s[i] = -np.inf
        o = np.lexsort((ids, -s))[:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in o if s[j] > -np.inf]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def frame(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(v) for v in r], 0) for i, r in zip(ids, x)], "vec_id long, embedding array<float>, cell int")


def test_recall_on_the_table(spark, qs):
    sf = "/root/testdata/sf0.1"
    got = found(qs["op5_nearest_vectors"](spark, sf))
    t = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    want = brute(t["vec_id"].to_numpy(), np.stack(t["embedding"]).astype(float))
    assert got.keys() == want.keys()
    hits = np.mean([len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / len(want[q]) for q in want])
    assert hits >= 0.9
    for q, rows in got.items():
        exact = dict(want[q])
        assert all(abs(s - exact[i]) < 1e-12 for i, s in rows if i in exact)


def test_visiting_part_of_the_cells(spark):
    rng = np.random.RandomState(3)
    x = rng.randn(6000, 32).astype(np.float32)
    ids = np.arange(6000)
    got = found(M.search(frame(spark, ids, x), F.col("vec_id") % 20 == 0, least=0))
    want = brute(ids, x.astype(float))
    assert np.mean([len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 20 for q in want]) >= 0.9


@pytest.mark.parametrize("rows_a_part", [40, 40_000])
def test_exact_when_all_cells_are_visited(spark, rows_a_part, monkeypatch):
    monkeypatch.setattr(M, "PART_ROWS", rows_a_part)
    rng = np.random.RandomState(4)
    x = rng.randn(400, 9).astype(np.float32)
    x[100:300] = x[100]                          # a very common vector
    ids = rng.permutation(400)
    want = {q: [(a, pytest.approx(s, abs=1e-12)) for a, s in r] for q, r in brute(ids, x.astype(float)).items()}
    assert found(M.search(frame(spark, ids, x), F.col("vec_id") % 20 == 0, visit=1.0, centroids=8)) == want


def test_cells_are_taken_in_order():
    rng = np.random.RandomState(5)
    a, b, sizes = rng.randn(7), rng.randn(5), rng.randint(0, 9, 35)
    for want in (1, 20, 80, 10**6):
        flags = M.visited_cells(a, b, sizes, want)
        total = (a[:, None] + b[None, :]).ravel()
        order = np.argsort(-total)
        n = int(np.searchsorted(np.cumsum(sizes[order]), want)) + 1
        assert set(np.flatnonzero(flags)) == set(order[:n])


def test_defined_cases(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [None, 1.0]),
            (None, [1.0, 1.0]), (6, [float("inf"), 1.0]), (7, [1.0]), (8, [0.5, 0.5]), (20, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = found(M.search(df, F.col("vec_id") % 20 == 0))
    assert got == {0: [(1, 0.5), (8, 0.5), (20, -1.0)], 20: [(1, -0.5), (8, -0.5), (0, -1.0)]}
    assert M.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert M.search(df.filter("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0
