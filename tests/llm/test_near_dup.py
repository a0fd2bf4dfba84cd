import random

import numpy as np
import pytest

from ledgerlink.llm import near_dup as N


def shingles(text):
    w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if x]
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [x for x in groups[find(i)] if x is not None]
        c = (min(ids) if ids else None) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(d, t, "x", 0) for d, t in rows], "doc_id long, text string, set_key string, n long")
    return sorted((tuple(r) for r in N.near_duplicates(df).collect()), key=str)


def corpus(seed, n=120):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    common = [rnd.choice(words) for _ in range(40)]
    rows = []
    for i in range(n):
        kind = rnd.random()
        if kind < 0.35 and rows:                 # a near copy of an earlier one
            w = (rnd.choice(rows)[1] or "").split()
            for _ in range(rnd.randint(0, 6)):
                if w:
                    w[rnd.randrange(len(w))] = rnd.choice(words)
            w = w[rnd.randint(0, 3):]
        else:
            w = [rnd.choice(words) for _ in range(rnd.randint(20, 120))]
            if kind > 0.7:                       # a passage that many share
                w += common
        rows.append((i * 13 % 1009, " ".join(w)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(spark, seed, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 8)           # many blocks
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_defined_cases(spark):
    long = " ".join(f"t{i}" for i in range(30_000))
    rows = [(5, None), (6, ""), (7, " \n\t"), (8, "one two"), (9, "ONE  two"), (9, "ONE  two"), (None, "one two"), (10, long),
            (11, long + " end"), (None, "lonely text of six small words"), (12, "É a b c d e"), (13, "é a b c d e")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:0]) == []


def test_chain_links_through_the_middle(spark):
    base = [f"a{i}" for i in range(200)]
    rows = [(i, " ".join(base[4 * i:] + [f"z{j}" for j in range(4 * i)])) for i in range(12)]
    got = run(spark, rows)
    assert got == brute(rows) and {r[2] for r in got} == {0}


def test_signature_estimates_similarity():
    a = np.arange(4000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    s = N.signatures([np.sort(a[:3000]), np.sort(a[1000:]), np.sort(a[:3000])])
    assert (s[0] == s[2]).all()
    assert abs((s[0] == s[1]).mean() - 0.5) < 0.25
