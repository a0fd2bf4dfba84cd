import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerlink.llm import katz as K


def toks(t):
    return [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").replace("\n", " ").replace("\t", " ").split(" ") if w] + [" "]


def held(d):
    return d is not None and zlib.crc32(str(d).encode()) % 7 == 2


def gt(n):
    d = {r: (r - 0.5) / r for r in range(1, 6)}
    if all(n[r] > 0 for r in range(1, 7)):
        cut = 6 * n[6] / n[1]
        for r in range(1, 6):
            v = ((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut) if cut < 1 else -1
            if 0 < v < 1:
                d[r] = v
    return d


class Plain:
    def __init__(self, rows):
        self.uni, self.bi = Counter(), Counter()
        for d, t in rows:
            if not held(d):
                w = toks(t)
                self.uni.update(w)
                self.bi.update(zip(["<s>"] + w, w))
        self.n = sum(self.uni.values())
        d1, d2 = gt(Counter(self.uni.values())), gt(Counter(self.bi.values()))
        self.p1 = {w: d1.get(c, 1) * c / (self.n + 1) for w, c in self.uni.items()}
        self.unk = 1 - sum(self.p1.values())
        self.ctx, self.after = Counter(), defaultdict(dict)
        for (h, w), c in self.bi.items():
            self.ctx[h] += c
        for (h, w), c in self.bi.items():
            self.after[h][w] = d2.get(c, 1) * c / (self.ctx[h] + 1)
        self.alpha = {h: (1 - sum(a.values())) / (1 - sum(self.p1[w] for w in a)) for h, a in self.after.items()}

    def p(self, w, h):
        if h not in self.after:
            return self.p1.get(w, self.unk)
        return self.after[h][w] if w in self.after[h] else self.alpha[h] * self.p1.get(w, self.unk)


def brute(rows):
    m = Plain(rows)
    out = []
    for d, t in rows:
        w = toks(t)
        base = sum(math.log10((m.uni[x] + 1) / (m.n + len(m.uni) + 1)) for x in w)
        out.append((d, held(d), len(w), sum(m.uni[x] > 0 for x in w), m.n, base, sum(math.log10(m.p(x, h)) for h, x in zip(["<s>"] + w, w))))
    return sorted(out, key=str), m


def run(spark, rows):
    df = spark.createDataFrame([(d, t, "c", 1) for d, t in rows], "doc_id long, text string, chunk string, part int")
    return sorted((tuple(r) for r in K.katz_scores(df).collect()), key=str)


def close(a, b):
    return len(a) == len(b) and all(x[:5] == y[:5] and x[5] == pytest.approx(y[5], rel=1e-9, abs=1e-9) and x[6] == pytest.approx(y[6], rel=1e-8, abs=1e-8) for x, y in zip(a, b))


def corpus(n, seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(200)]
    return [(i, " ".join(vocab[min(199, int(rnd.expovariate(0.05)))] if rnd.random() < 0.97 else f"rare{rnd.randrange(10**6)}" for _ in range(rnd.randint(0, 80)))) for i in range(n)]


@pytest.mark.parametrize("small", [False, True])
def test_equals_a_plain_model(spark, small, monkeypatch):
    if small:                                    # many chunks, ranges and split contexts
        monkeypatch.setattr(K, "CHUNK_TOKENS", 300)
        monkeypatch.setattr(K, "BUCKET_ENTRIES", 100)
        monkeypatch.setattr(K, "pieces", lambda texts, n: ((i, min(i + 7, len(texts))) for i in range(0, len(texts), 7)))
    rows = corpus(150, 3)
    want, model = brute(rows)
    assert close(run(spark, rows), want)
    for h in list(model.after)[:20]:             # every distribution sums to 1
        assert sum(model.p(w, h) for w in model.uni) + model.alpha[h] * model.unk == pytest.approx(1)


def test_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, "A a\tB\n b"), (3, "A a\tB\n b"), (None, "x y"), (4, "z " * 30_000), (5, "É é")]
    assert close(run(spark, rows), brute(rows)[0])
    assert run(spark, []) == []
    alone = [d for d in range(100) if held(d)][:3]
    got = run(spark, [(d, "some words") for d in alone])
    assert [r[4:] for r in got] == [(0, 0.0, 0.0)] * 3


def test_table(spark, qs):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in qs["op9_katz"](spark, sf).collect()), key=str)
    assert close(got, brute(docs)[0])
    assert np.mean([r[6] - r[5] for r in got]) > 0


def test_packing():
    for a in (np.arange(1000, dtype=np.uint64) ** 3, np.zeros(0, np.uint32), np.array([1.5, -2.0])):
        assert (K.unpack(K.pack(a), a.dtype.str) == a).all()
