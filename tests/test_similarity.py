"""All forms give the same bits, legal vectors only, and pruning that skips
pairs without losing one."""

import numpy as np
import pytest

from ledgerlink.operators import matching as MT
from ledgerlink.operators import similarity as SIM


def frame(spark, x, ids=None, kind="long"):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(i if kind == "long" else f"k{i:05d}", v.tolist() if hasattr(v, "tolist") else v) for i, v in zip(ids, x)], f"id {kind}, v array<double>")


def rows(df):
    return sorted(map(tuple, df.collect()))


def top(q, t, k=5, **kw):
    return rows(SIM.topk_cosine(q, t, k, "id", "v", "id", "v", **kw))


def clusters(rng, n, dim, centres, spread=0.05):
    c = rng.randn(centres, dim)
    return c[rng.randint(0, centres, n)] + spread * rng.randn(n, dim)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_pruned_form_gives_the_same_rows(spark, kind):
    rng = np.random.RandomState(1)
    x = clusters(rng, 900, 12, 9)
    x[100:400] = x[0]                                      # a third are copies
    x[500] = 0                                             # no direction
    q, t = frame(spark, x[::3], range(0, 900, 3), kind), frame(spark, x, kind=kind)
    want = top(q, t, exclude_self=True)
    assert top(q, t, exclude_self=True, mode="pruned", block_rows=64) == want == top(q, t, exclude_self=True, block_rows=50)
    assert len(want) == 300 * 5


def test_pruning_skips_pairs_of_clustered_vectors(spark):
    rng = np.random.RandomState(2)
    x = frame(spark, clusters(rng, 2000, 16, 20))
    visited, pairs = SIM.pruned_pairs(x, x, 5, "id", "v", "id", "v", block_rows=64)
    assert pairs == 2000 * 2000 and visited < 0.35 * pairs
    assert top(x, x, mode="pruned", block_rows=64) == top(x, x)


def test_without_clusters_nothing_is_lost(spark):
    x = frame(spark, np.random.RandomState(3).randn(500, 24))
    visited, pairs = SIM.pruned_pairs(x, x, 5, "id", "v", "id", "v", block_rows=100)
    assert visited <= pairs
    assert top(x, x, mode="pruned", block_rows=100) == top(x, x)


def test_reach_is_never_below_a_cosine():
    rng = np.random.RandomState(4)
    t, q = SIM._unit_rows(rng.randn(400, 6)), SIM._unit_rows(rng.randn(50, 6))
    cells = SIM.AngleCells(SIM._spread(t[:60], 8))
    cell, angle = cells.place(t)
    names = np.unique(cell)
    cells.deal(names, np.array([angle[cell == x].min() for x in names]), np.array([angle[cell == x].max() for x in names]),
               np.array([(cell == x).sum() for x in names]), 50)
    reach = cells.reach(q)
    for i, x in enumerate(names):
        assert (reach[:, i] + 1e-9 >= (q @ t[cell == x].T).max(axis=1)).all()
    assert cells.n_blocks >= 8 and (cells.first + cells.splits <= cells.n_blocks).all()


def test_unusable_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    bad = [None, [1.0, None], [nan, 1.0], [inf, 0.0], [1.0], []]
    good = [[1.0, 0.0], [0.0, 0.0], [1.0, 1.0]]
    t = frame(spark, bad + good, kind="long")
    want = [(6, 1, 6, 1.0), (6, 2, 8, pytest.approx(0.5 ** 0.5)), (6, 3, 7, 0.0), (7, 1, 6, 0.0), (7, 2, 7, 0.0), (7, 3, 8, 0.0),
            (8, 1, 8, pytest.approx(1.0)), (8, 2, 6, pytest.approx(0.5 ** 0.5)), (8, 3, 7, 0.0)]
    for mode in ("blocked", "broadcast", "pruned"):
        assert top(t, t, mode=mode) == want, mode
        assert top(t, t.filter("id < 6"), mode=mode) == top(t, t.limit(0), mode=mode) == []


def test_scores_at_a_rounding_border_have_one_rank():
    # cosines of exactly 2 ** -10 lie halfway between two ranks' scores
    rng = np.random.RandomState(5)
    q = rng.randint(-3, 4, (40, 16)).astype(float)
    t = rng.randint(-3, 4, (3000, 16)).astype(float)
    ids = np.arange(3000)
    want = SIM.topk_block(np.arange(40), q, None, ids, t, None, 50, False)
    for chunk in (64, 1000):
        got = SIM.topk_block(np.arange(40), q, None, ids, t, None, 50, False, chunk=chunk)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
    one = [SIM.topk_block(np.arange(1), q[i:i + 1], None, ids, t, None, 50, False) for i in range(40)]
    assert all((s[0] == want[0][i]).all() and (j[0] == want[1][i]).all() for i, (s, j) in enumerate(one))


def test_rating_at_bucket_borders(spark):
    below = [x - 1e-16 * 3 for x in (0.2, 0.4, 0.6, 0.8, 1.0)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate([0.2, 0.4, 0.6, 0.8, 1.0] + below)], "i int, v double")
    got = [r["Rating"] for r in MT.flag_mismatches(df, "v").orderBy("i").collect()]
    assert got == [2, 3, 4, 5, 5] * 2


def test_pruned_form_takes_no_groups(spark):
    x = frame(spark, np.eye(3))
    with pytest.raises(ValueError):
        SIM.topk_cosine(x, x, 1, "id", "v", "id", "v", "id", "id", mode="pruned")


def test_blocks_do_not_grow_with_the_square_of_the_table(spark):
    import re

    x = frame(spark, np.random.RandomState(6).randn(4500, 4))
    blocks = lambda df: set(re.findall(r"(\d+) AS _b[qt]", df._jdf.queryExecution().analyzed().toString()))
    small = blocks(SIM.topk_cosine(x, x, 3, "id", "v", "id", "v", block_rows=16))
    assert small == {str(SIM.MOST_SIDES)}                       # not 282 copies of every row
    assert blocks(SIM.topk_cosine(x, x, 3, "id", "v", "id", "v")) == {"5"}     # nor all pairs in one task
    cells = SIM._pruned_parts(x, x, 3, "id", "v", "id", "v", False, 16)[0]
    assert cells.n_blocks <= 2 * SIM.MOST_BLOCKS


def test_scores_that_are_known_leave_out_only_lower_ranks():
    rng = np.random.RandomState(7)
    t = np.concatenate([np.tile(rng.randn(1, 8), (700, 1)), rng.randn(2300, 8), rng.randint(-1, 2, (2000, 8))])
    ids, q = np.arange(5000), t[::50]
    want = SIM.topk_block(ids[::50], q, None, ids, t, None, 6, True)
    unit = SIM._unit_rows(t)
    s = np.stack([SIM._row_products(unit[::50], unit[j][None, :]) for j in range(5000)], axis=1)
    s[ids[::50][:, None] == ids[None, :]] = -np.inf
    order = np.lexsort((np.broadcast_to(ids, s.shape), -SIM._rank_key(s)), axis=1)[:, :6]
    assert (want[1] == order).all() and (want[0] == np.take_along_axis(s, order, axis=1)).all()
    known = SIM.topk_block(ids[::50], q, None, ids[1::2], t[1::2], None, 6, True)[0][:, 5]
    got = SIM.topk_block(ids[::50], q, None, ids, t, None, 6, True, least=known)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_searches_take_every_vector_against_all(spark, qs, tmp_path):
    rnd = np.random.default_rng(5)
    vecs = {i: [float(x) for x in np.float32(rnd.normal(size=4))] for i in range(-100, 250)}
    rows = [(i, v, i % 3) for i, v in vecs.items()] + [(300, None, 1), (None, vecs[7], 1)]        # no vector, no id
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    ids, m = np.array(list(vecs)), np.array(list(vecs.values()))
    s = np.round((m @ m.T) / np.outer(np.linalg.norm(m, axis=1), np.linalg.norm(m, axis=1)), 9)
    np.fill_diagonal(s, -np.inf)
    want = sorted((int(ids[a]), r + 1, int(ids[b])) for a in range(len(ids)) for r, b in enumerate(np.lexsort((ids, -s[a]))[:10]))
    for k in ("cosine_topk", "cosine_topk_blocked", "cosine_topk_pruned"):
        assert sorted(tuple(r)[:3] for r in qs[k](spark, str(tmp_path)).collect()) == want, k
    lists = {r["q_id"]: r["cand_ids"] for r in qs["candidates_array"](spark, str(tmp_path)).collect()}
    assert lists == {int(i): ",".join(str(t) for q, _, t in want if q == i) for i in ids}
    best = qs["choose_match"](spark, str(tmp_path)).collect()
    assert sorted(r["q_id"] for r in best) == ids.tolist()
    assert {(r["q_id"], r["chosen_id"]) for r in best} <= {(q, t) for q, _, t in want}
    chosen = {r["q_id"]: r["chosen_id"] for r in best} | {300: None, None: None}
    flags = qs["flag_mismatches"](spark, str(tmp_path)).collect()
    assert len(flags) == len(rows) and {r["vec_id"]: r["chosen_id"] for r in flags} == chosen
    assert all((r["Rating"] is None) == (r["chosen_id"] is None) for r in flags)
