import hashlib
import random
import re

import pytest

from ledgerlink.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items):
    runs = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1) if n else ():
            runs.setdefault(tuple(w[i:i + n]), set()).add(None if item is None else str(item))
    out = []
    for d, text in docs:
        w, hit, names = words(text), set(), set()
        for n in {len(r) for r in runs}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in runs:
                    hit.update(range(i, i + n))
                    names |= runs[tuple(w[i:i + n])]
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(x for x in names if x is not None)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n_hit int, item string")
    b = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, doc_id string")
    return sorted((tuple(r) for r in D.decontaminate(d, b).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_all_windows(spark, seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(6 if seed == 3 else 40)] + ["É", "é", "x9"]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([3, 5, 7, 9, 10, 11, 25] if seed > 1 else [10, 14, 30])))) for i in range(12)]
    docs = []
    for i in range(60):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 2)):
            p = rnd.choice(items)[1].split()
            a = rnd.randint(0, max(0, len(p) - 12))
            at = rnd.randint(0, len(w))
            w[at:at] = p[a:a + rnd.randint(4, 20)]
        docs.append((i, rnd.choice([" ", "\n", ", ", "|"]).join(w).upper() if i % 5 == 0 else " ".join(w)))
    assert run(spark, docs, items) == brute(docs, items)


def test_defined_cases(spark):
    a = " ".join(f"a{i}" for i in range(15))
    docs = [(1, None), (2, ""), (3, "...!"), (None, a), (4, a), (4, a), (4, "other"), (5, "x " * 50_000 + a.upper() + "," + a)]
    items = [(7, a), (7, a), (11, a), (None, "x x x x x x x x x x"), (8, None), (9, " ")]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, []) == brute(docs, [])
    assert run(spark, [], items) == []


def test_items_without_an_id_and_items_that_share_a_passage(spark):
    import duckdb
    import pandas as pd
    a, b = " ".join(f"a{i}" for i in range(10)), " ".join(f"b{i}" for i in range(12))
    items = [(None, a), (None, b + " x"), *[(i, f"{b} own{i} " + " ".join(f"o{i}x{j}" for j in range(9))) for i in range(30)]]
    docs = [(1, a), (2, f"so {a} {b}"), (3, b + " " + items[5][1]), (4, "clean"), (5, b), (6, b)]
    got = run(spark, docs, items)
    assert got == brute(docs, items)
    assert got[0][1:4] == (10, 10, 1) and got[0][5] and got[1][3] == 31
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]))
    con.register("benchmark", pd.DataFrame({"item_id": pd.array([i for i, _ in items], dtype="Int64"), "text": [t for _, t in items]}))
    assert sorted(con.execute(D.ORACLE).fetchall(), key=str) == got


def test_whole_shared_span_is_found_wherever_it_starts(spark):
    span = [f"s{i}" for i in range(10)]
    docs = [(i, " ".join([f"p{j}" for j in range(i)] + span + ["q"] * (i % 7))) for i in range(30)]
    assert all(r[2] == 10 for r in run(spark, docs, [(1, " ".join(["b"] * 3 + span + ["c"] * 4))]))


def test_no_python_in_the_plan(spark, qs):
    from tests.conftest import plan_text
    plan = plan_text(qs["op3_decontaminate"](spark, "/root/testdata/sf0.001"))
    assert "Python" not in plan and "Pandas" not in plan
