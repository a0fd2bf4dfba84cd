import hashlib

import numpy as np
import pytest

from ledgerlink.llm import pivot_codes as V


def brute(rows):
    """Plain Python over (vec_id, vector, label) with unique ids."""
    kept = sorted(((i, [int(np.floor(float(x) * 4096)) if abs(x) < 1e300 else int(x) * 4096 for x in v], lab) for i, v, lab in rows
                   if v and all(x is not None and np.isfinite(x) for x in v)), key=lambda r: r[0])
    w = len(kept[0][1]) // 8
    cut = [[v[p * w:(p + 1) * w] for p in range(8)] for _, v, _ in kept]
    books = [[x[p] for x in cut[:16]] for p in range(8)]
    d = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    pick = lambda x, p: min((d(x, e), i) for i, e in enumerate(books[p]))
    for _ in range(6):
        where = [[pick(x[p], p)[1] for p in range(8)] for x in cut]
        new = []
        for p in range(8):
            book = []
            for e, old in enumerate(books[p]):
                members = [x[p] for x, a in zip(cut, where) if a[p] == e]
                book.append([sum(m[j] for m in members) // len(members) for j in range(w)] if members else old)
            new.append(book)
        books = new
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    out = {}
    for (i, _, lab), x in zip(kept, cut):
        best = [pick(x[p], p) for p in range(8)]
        out[i] = ("".join(f"{e:02x}" for _, e in best), sum(s for s, _ in best), lab)
    total = {}
    for _, e, lab in out.values():
        total[lab] = total.get(lab, 0) + e
    return {i: (c, e, total[lab], sha) for i, (c, e, lab) in out.items()}


def coded(spark, rows, kind="double"):
    df = spark.createDataFrame([(i, v, lab, "x") for i, v, lab in rows], f"vec_id long, embedding array<{kind}>, label int, code string")
    out, books = V.compress(df)
    return {r.vec_id: (r.code, r.error, r.label_error, V.codebooks_digest(books)) for r in V.with_label_error(out).collect()}


@pytest.mark.parametrize("seed,n,dim", [(1, 300, 64), (2, 9, 16), (3, 200, 8)])
def test_equals_plain_python(spark, seed, n, dim):
    rng = np.random.RandomState(seed)
    x = rng.randn(n, dim).round(1 if dim == 8 else 6)         # few values: many ties
    x[n // 2: n // 2 + n // 3] = x[0]                         # a group of copies
    rows = [(int(i), v.tolist(), None if i % 5 == 0 else int(i % 3)) for i, v in zip(rng.permutation(n), x)]
    assert coded(spark, rows) == brute(rows)


def test_whole_table_against_plain_python(spark, qs):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = {r.vec_id: (r.code, r.error, r.label_error, r.codebooks_sha256) for r in qs["op12_vector_codes"](spark, sf).collect()}
    assert got == brute(rows)


def test_pruning_keeps_the_answer_and_skips_distances():
    rng = np.random.RandomState(4)
    centres = rng.randint(-20000, 20000, (16, 8))
    x = centres[rng.randint(0, 16, 4000)] + rng.randint(-300, 300, (4000, 8))
    pivots = V.far_apart(centres, V.PIVOTS)
    far = np.stack([V.root(V.squared(x, p)) for p in pivots], axis=1)
    index, best, evaluated = V.Position(pivots, centres).nearest(x, far)
    every = np.stack([V.squared(x, e) for e in centres], axis=1)
    assert (index == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert evaluated < 0.2 * every.size


def test_equal_distances_go_to_the_lower_index():
    entries = np.array([[4, 0], [-4, 0], [0, 4], [4, 0]])
    pivots = V.far_apart(entries, 4)
    x = np.array([[0, 0], [4, 0], [0, 1], [-1, 1]])
    far = np.stack([V.root(V.squared(x, p)) for p in pivots], axis=1)
    assert V.Position(pivots, entries).nearest(x, far)[0].tolist() == [0, 0, 2, 1]


def test_very_large_numbers(spark):
    rng = np.random.RandomState(5)
    rows = [(i, (rng.randn(8) * 10.0 ** rng.randint(0, 20)).tolist(), 0) for i in range(40)]
    want = brute(rows)
    got = coded(spark, rows)
    assert {i: (c, s) for i, (c, _, _, s) in got.items()} == {i: (c, s) for i, (c, _, _, s) in want.items()}
    assert all(got[i][1] == (e if e < 2 ** 63 else None) for i, (_, e, _, _) in want.items())
    assert any(v[1] is None for v in got.values()) and all(v[2] is None for v in got.values())
    assert sum(d << V.LIMB * p for p, d in V.limbs(10 ** 40)) == 10 ** 40


def test_many_labels_are_salted(spark, monkeypatch):
    rng = np.random.RandomState(6)
    rows = [(i, rng.randn(8).tolist(), None if i < 20 else i % 4) for i in range(60)]
    monkeypatch.setattr(V, "LABEL_BYTES", 0)
    assert coded(spark, rows) == brute(rows)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i * j % 7) for j in range(8)], 0) for i in range(5)]
    bad = [(90, None, 0), (91, [nan] + [0.0] * 7, 0), (92, [None] + [0.0] * 7, 0), (93, [inf] * 8, 0), (94, [1.0], 0), (95, [1.0] * 16, 0), (96, [], 0)]
    assert coded(spark, good + bad) == brute(good)
    df = spark.createDataFrame(good, "vec_id long, embedding array<float>, label int")
    assert V.compress(df.limit(0))[0].count() == 0 and V.with_label_error(V.compress(df.limit(0))[0]).columns[-1] == "label_error"
    again = spark.createDataFrame(good + good[:2] + [(None, [9.0] * 8, None)], df.schema)
    out = V.with_label_error(V.compress(again)[0]).collect()
    assert len(out) == 8 and sum(r.vec_id is None for r in out) == 1 and len({r.code for r in out if r.vec_id == 1}) == 1
