"""Batches that keep to a token budget, against plain greedy packing."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlink.operators import relational as RL


def greedy(rows, budget):
    out, batch, held, any_tokens, total = [], 0, 0, False, 0
    for key, t in rows:
        n = max(t or 0, 0)
        if n and any_tokens and held + n > budget:
            batch, held = batch + 1, 0
        any_tokens, held = any_tokens or n > 0, held + n
        out.append((key, total, batch))
        total += n
    return out


def batches(spark, rows, budget, **kw):
    shuffled = random.Random(5).sample(rows, len(rows))
    df = spark.createDataFrame(shuffled, "k long, t long")
    got = RL.token_budget_batches(df, ["k"], "t", budget, **kw)
    assert got.columns == ["k", "t", "tokens_before", "batch_id"]
    return [(r.k, r.tokens_before, r.batch_id) for r in got.orderBy("k").collect()]


@pytest.mark.parametrize("seed,n,most,budget,blocks", [(1, 400, 30, 100, 1), (2, 300, 5, 7, 2), (3, 200, 400, 100, 1), (4, 500, 1, 3, 1), (5, 60, 9, 10**6, 16)])
def test_equals_greedy_packing(spark, seed, n, most, budget, blocks):
    rng = random.Random(seed)
    rows = [(k, rng.choice([0, 0, None, -3, rng.randint(1, most), rng.randint(1, most), rng.randint(1, most)])) for k in range(n)]
    assert batches(spark, rows, budget, pack_budgets=blocks) == greedy(rows, budget)


def test_no_batch_exceeds_the_budget(spark):
    rng = random.Random(6)
    rows = [(k, rng.randint(1, 60) if rng.random() < 0.95 else rng.randint(150, 2000)) for k in range(800)]
    sizes = {}
    for (_, t), (_, _, b) in zip(rows, batches(spark, rows, 200, pack_budgets=1)):
        sizes.setdefault(b, []).append(t)
    assert all(sum(x) <= 200 or len(x) == 1 for x in sizes.values())
    assert sorted(sizes) == list(range(len(sizes)))
    assert any(len(x) == 1 and x[0] > 200 for x in sizes.values())


def test_a_long_run_of_rows_without_tokens(spark):
    rows = [(k, 0) for k in range(50)] + [(50, 5)] + [(k, 0) for k in range(51, 300)] + [(300, 6), (301, 4), (302, 0)]
    assert batches(spark, rows, 10, pack_budgets=1) == greedy(rows, 10)


def test_edges(spark):
    assert batches(spark, [(1, 0), (2, None)], 5) == [(1, 0, 0), (2, 0, 0)]
    assert batches(spark, [(1, 7)], 5) == [(1, 0, 0)]
    empty = spark.createDataFrame([], "k long, t long")
    assert RL.token_budget_batches(empty, ["k"], "t", 5).count() == 0
    with pytest.raises(ValueError):
        RL.token_budget_batches(empty, ["k"], "t", 0)


def test_pointers_shrink_and_no_partition_holds_all_rows(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 7 + 1).alias("t"))
    out = RL.token_budget_batches(df, ["k"], "t", 50, pack_budgets=1)
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    assert [(r.k, r.tokens_before, r.batch_id) for r in out.orderBy("k").collect()] == greedy([(k, k % 7 + 1) for k in range(3000)], 50)
