import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlink.llm import mixing as M


def made(n, seed=1):
    rnd = random.Random(seed)
    sets = {"x": ["la", "le", "mur", "pas"], "y": ["the", "of", "wall", "pas"], "z": ["der", "und", "wand", "pas"]}
    out = []
    for i in range(n):
        d = rnd.choices("xyz", [6, 3, 1])[0]
        out.append((i, " ".join(rnd.choice(sets[d] if rnd.random() < 0.8 else sets["x"]) for _ in range(rnd.randint(1, 90))), d))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, d, 0.5, 3) for i, t, d in rows], "doc_id long, text string, domain string, rate double, n_tokens int")


def test_rates_hit_targets_as_a_plain_solver_does(spark):
    docs = frame(spark, made(600))
    model = M.fit_domains(docs.select("text", "domain"))
    members = M.posteriors(docs, model).orderBy("doc_id").toPandas()
    p, n = np.stack(members["p"]), members["n_tokens"].to_numpy(float)
    assert np.allclose(p.sum(1), 1)
    for weights, budget in ([0.4, 0.3, 0.3], None), ([0.0, 0.9, 0.1], None), ([0.02, 0.03, 0.95], n.sum()):
        got = M.mix(docs, docs.select("text", "domain"), dict(zip("xyz", weights)), budget).orderBy("doc_id").toPandas()
        r = got["rate"].to_numpy()
        assert (r >= 0).all()
        totals = (r * n) @ p
        w = np.array(weights) / sum(weights)
        t = n @ p
        want = (budget or max(a / b for a, b in zip(t, w) if b > 0)) * w
        # plain projected gradient in the same metric
        q = np.ones(len(n))
        inv = np.linalg.pinv((p * n[:, None]).T @ p, rcond=1e-12)
        for _ in range(M.STEPS):
            q = np.maximum(0, q - p @ (inv @ ((q * n) @ p - want)))
        assert np.allclose(totals, (q * n) @ p, rtol=1e-5, atol=1e-6 * want.sum())
    assert np.allclose(totals[2] / totals.sum(), (q * n) @ p[:, 2] / ((q * n) @ p).sum())


def test_posteriors_equal_plain_python(spark):
    rows = made(80)
    docs = frame(spark, rows)
    domains, prior, like = M.fit_domains(docs.select("text", "domain"))
    code = {r.w: r.c for r in docs.select(F.explode(F.split("text", " ")).alias("w")).distinct().withColumn("c", F.pmod(F.xxhash64("w"), F.lit(M.BUCKETS))).collect()}
    got = {r.doc_id: r.p for r in M.posteriors(docs, (domains, prior, like)).collect()}
    for i, text, _ in rows:
        w = text.split()
        z = np.array([q + min(1, M.EVIDENCE / len(w)) * sum(t[code[x]] for x in w) for q, t in zip(prior, like)])
        e = np.exp(z - z.max())
        assert np.allclose(got[i], e / e.sum())


def test_table(spark, qs):
    sf = "/root/testdata/sf0.01"
    out = qs["op2_mixing"](spark, sf)
    from tests.conftest import plan_text
    assert "Python" not in plan_text(out) and "Pandas" not in plan_text(out)
    got = out.join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == 1000 and (got["domain"] == got["lang"]).mean() > 0.9
    hard = (got["rate"] * got["n_tokens"]).groupby(got["domain"]).sum()
    for d, w in M.TARGETS.items():
        assert abs(hard[d] / hard.sum() - w) < 0.05


def test_defined_cases(spark):
    docs = frame(spark, [(1, None, "x"), (2, "", "x"), (None, "der und " * 20_000, "z"), (3, "la le", "x"), (3, "la le", "x"), (4, "der", None)])
    out = M.mix(docs, docs.select("text", "domain"), {"x": 1, "z": 1}).toPandas()
    assert len(out) == 6 and sorted(out["n_tokens"]) == [0, 0, 1, 2, 2, 40_000]
    assert M.mix(docs.limit(0), docs.select("text", "domain"), {"x": 1}).count() == 0
    assert M.mix(docs, docs.select("text", "domain").limit(0), {"x": 1}).select("rate").distinct().collect()[0][0] == 1
    for bad in ({"x": -1, "z": 2}, {"q": 1}, {"x": 0}):
        with pytest.raises(ValueError):
            M.mix(docs, docs.select("text", "domain"), bad)


def test_copies_have_the_rate_as_mean(spark):
    df = spark.range(20_000).select(M.copies(F.lit(1.3), F.col("id")).alias("c"))
    r = df.agg(F.avg("c"), F.min("c"), F.max("c")).first()
    assert abs(r[0] - 1.3) < 0.02 and (r[1], r[2]) == (1, 2)


def test_domain_without_a_target_keeps_its_share(spark):
    rnd = random.Random(4)
    rows = made(300) + [(1000 + i, " ".join(rnd.choice(["il", "lo", "muro", "che"]) for _ in range(rnd.randint(5, 60))), "w") for i in range(60)]
    docs = frame(spark, rows)
    targets = {"x": 0.4, "y": 0.3, "z": 0.3}
    got = M.mix(docs, docs.select("text", "domain"), targets).toPandas()
    tokens, after = got["n_tokens"], got["rate"] * got["n_tokens"]
    own = got["domain"] == "w"
    assert own.sum() >= 55 and got["rate"][own].min() > 0.9
    assert abs(after[own].sum() / after.sum() - tokens[own].sum() / tokens.sum()) < 0.02
    mixed = M.mix_documents(docs, docs.select("text", "domain"), targets)
    assert {r.doc_id for r in mixed.select("doc_id").collect()} == {r[0] for r in rows}
