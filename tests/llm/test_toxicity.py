import random

import numpy as np
import pytest

from ledgerlink.llm import toxicity as T


def made(n, seed, bad):
    rnd = random.Random(seed)
    syl = ["ka", "lo", "mi", "ren", "ta", "sho", "vel", "pu", "gar", "in"]
    docs, labels = [], []
    for i in range(n):
        w = ["".join(rnd.choice(syl) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(30, 200))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(max(1, len(w) // 40)):
                w.insert(rnd.randrange(len(w)), rnd.choice(bad))
        docs.append((i, " ".join(w), "en", 0.5))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_unseen_misspellings(spark):
    docs, labels = made(900, 1, ["idiot", "worthless", "moronic"])
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, score double")
    model = T.train(T.labelled_sample(d, spark.createDataFrame(labels, "doc_id long, toxic int")))
    other, truth = made(200, 2, ["idiott", "worthles", "idi0ot", "moronics"])
    df = spark.createDataFrame(other, "doc_id long, text string, lang string, score double")
    got = dict(map(tuple, df.select("doc_id", T.score(df, model)).collect()))
    hits = [(got[i] >= T.CUT) == bool(t) for i, t in truth]
    assert np.mean(hits) > 0.93


def test_table(spark, qs):
    sf = "/root/testdata/sf0.1"
    out = qs["op4_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    held = out[out["held_out"]]
    tp = ((held["predicted"] == 1) & (held["toxic"] == 1)).sum()
    assert tp / (held["toxic"] == 1).sum() > 0.9          # some 300 toxic rows teach here
    assert tp / max(1, (held["predicted"] == 1).sum()) > 0.93


def test_bags_equal_plain_python():
    texts = ["The IDIOT, the é!", "", None, "aa b aa aa", "x" * 3000]
    for first, last, starts, weight, grams in T.bags(texts, most_bytes=20):
        for k in range(first, last):
            s, e = starts[k - first], (list(starts) + [len(weight)])[k - first + 1]
            index, value = T.counts(s, e, weight, grams)
            words = (texts[k] or "").lower().encode().translate(T._KEEP).split()
            want = {}
            for w in words:
                v = b" " + w + b" "
                for n in T.GRAMS:
                    for i in range(len(v) - n + 1):
                        h = 0
                        for c in v[i:i + n]:
                            h = (h * 0x100000001B3 + c) % 2**64
                        h = (h + n) * 0x9E3779B97F4A7C15 % 2**64 >> (64 - T.BUCKETS_LOG2)
                        want[h] = want.get(h, 0) + words.count(w) ** -T.DAMP
            assert dict(zip(index.tolist(), value.tolist())) == pytest.approx(want, rel=1e-5)


def test_defined_cases(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "some text", 1), (3, "y" * 100_000, 1), (3, "y" * 100_000, 1)], "doc_id long, text string, label int")
    labels = spark.createDataFrame([(1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    rows = T.toxicity(docs, labels).collect()
    assert len(rows) == 5 and all(r.score == 0 and r.predicted == 0 for r in rows)
    assert not [r for r in rows if r.doc_id is None][0].held_out
    assert T.toxicity(docs.limit(0), labels.limit(0)).count() == 0


def sample(n=300, seed=5):
    docs, labels = made(n, seed, ["idiot", "worthless", "moronic"])
    bags = [T.counts(s, e, weight, grams) for first, last, starts, weight, grams in T.bags([d[1] for d in docs])
            for s, e in zip(starts, np.append(starts[1:], len(weight)))]
    parts = [(i, v / (v.sum() + T.NEUTRAL)) for i, v in bags]
    return parts, np.array([x for _, x in labels], dtype=float)


def fitted(parts, y, **kw):
    return T.fit(np.concatenate([i for i, _ in parts]), np.concatenate([v for _, v in parts]), np.array([len(i) for i, _ in parts]), y, **kw)


def test_embeddings_and_softmax_both_learn():
    parts, y = sample()
    emb, soft, bias = fitted(parts, y)
    none, first, _ = fitted(parts, y, epochs=0)
    learnt = emb[emb.any(axis=1)]
    values = np.linalg.svd(learnt / np.linalg.norm(learnt), compute_uv=False)
    assert (values > 0.01).all()                                  # all DIM dimensions are in use
    assert (np.abs(soft - first) > 1e-3).any(axis=1).all()        # both columns moved
    d, d0 = soft[1] - soft[0], first[1] - first[0]
    assert d @ d0 / np.linalg.norm(d) / np.linalg.norm(d0) < 0.99999
    assert np.linalg.norm(emb - none) > np.linalg.norm(none)


def test_fit_equals_a_dense_softmax_network():
    """The same descent with whole matrices, two softmax columns and chain-rule gradients."""
    parts, y = sample(120, 6)
    emb, soft, bias = fitted(parts, y)
    kept = np.flatnonzero(emb.any(axis=1))
    x = np.zeros((len(y), T.BUCKETS), dtype=np.float32)
    for r, (i, v) in enumerate(parts):
        x[r, i] = v
    x = x[:, kept].astype(float)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    scale = 1 / (np.sqrt((x ** 2).mean(axis=0)) + np.sqrt(10 / len(y)) * x[x > 0].mean())
    xs = x * scale
    centred = xs - weight @ xs
    rng = np.random.RandomState(11)
    u = rng.normal(size=len(kept))
    for _ in range(6):
        u = centred.T @ (weight * (centred @ u))
        top = np.linalg.norm(u)
        u /= top
    e, w, b = T.start(len(kept), rng)
    z = centred @ e @ (w[1] - w[0])
    e = e * T.START / np.sqrt(weight @ z ** 2)
    held = ahead = (e, w, b)
    want = np.stack([1 - y, y], axis=1)
    for t in range(T.EPOCHS):
        e, w, b = ahead
        hidden = centred @ e
        logits = hidden @ w.T + b
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        error = weight[:, None] * (p - want)
        d = w[1] - w[0]
        lr = 1 / (0.375 * top * (d @ d + 2 * np.linalg.svd(e, compute_uv=False)[0] ** 2))
        new = (e - lr * (centred.T @ error @ w + T.RIDGE * e), w - lr * (error.T @ hidden), b - 0.5 * error.sum(axis=0))
        ahead = tuple(n + t / (t + 3) * (n - h) for n, h in zip(new, held))
        held = new
    e, w, b = held
    logits = centred @ e @ w.T + b
    plain = 1 / (1 + np.exp(logits[:, 0] - logits[:, 1]))
    got = 1 / (1 + np.exp(-(x @ emb[kept] @ (soft[1] - soft[0]) + bias[1] - bias[0])))
    assert np.abs(got - plain).max() < 1e-6


def test_nothing_to_learn_scores_a_half(spark):
    docs = spark.createDataFrame([(i, "same words") for i in range(12)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, toxic int")
    assert {r.score for r in T.toxicity(docs, labels).collect()} == {0.5}
