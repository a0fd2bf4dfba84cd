"""Disclosing terms are looked for in the whole text that holds an entity, not only beside its mention."""
import math
import random
import re

from ledgerlink.llm import personal_data as P
from tests.llm.test_personal_data import base, brute, run

WORD = re.compile(r"[^\W\d_][^\W_]{2,}")


def whole(rows):
    """(doc_id, spans) with terms of whole texts."""
    found, n_term, rows_of, pairs, free = [base(t) for _, t in rows], {}, {}, {}, []
    for i, ((_, t), f) in enumerate(zip(rows, found)):
        for w in set(WORD.findall((t or "").lower())):
            n_term[w] = n_term.get(w, 0) + 1
        taken = [(s, e) for k in P.KINDS for s, e, _ in f[k]]
        words = [(m.start(), m.end(), m[0].lower()) for m in WORD.finditer(t or "")]
        free.append([(x, y, w) for x, y, w in words if not any(s < y and x < e for s, e in taken)])
        for entity in {f"{k}:{v.lower()}" for k in P.KINDS for _, _, v in f[k]} if free[i] else ():
            rows_of.setdefault(entity, set()).add(i)
            at = [(max(0, s - 60), e + 60, (t[max(0, s - 60):s], t[e:e + 60])) for k in P.KINDS for s, e, v in f[k] if f"{k}:{v.lower()}" == entity]
            for w in {w for _, _, w in free[i]}:
                near = {c for x, y, v in free[i] if v == w for a, b, c in at if a <= x and y <= b}
                # one context a document: how many there are does not depend on which of a text's places stands for it here
                far = min(tuple(v for z, _, v in words if abs(z - x) <= 60) for x, _, v in free[i] if v == w)
                p = pairs.setdefault((entity, w), (set(), set()))
                p[0].update(near or {far})
                p[1].add(i)
    telling = {k for k, (c, r) in pairs.items() if len(c) >= P.CONTEXTS and len(r) / max(n_term[k[1]], len(r)) >= math.pow(len(rows_of[k[0]]) / len(rows), 1 - P.ALPHA)}
    out = []
    for i, ((d, _), f) in enumerate(zip(rows, found)):
        told = {w for e, w in telling if i in rows_of.get(e, ())}
        out.append((d, ",".join([f"{k}:{s}:{e}" for k in P.KINDS for s, e, _ in f[k]] + [f"term:{x}:{y}" for x, y, w in free[i] if w in told])))
    return sorted(out, key=str)


def test_equals_plain_python_over_whole_texts(spark):
    rnd = random.Random(5)
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    some = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    rows = []
    for i in range(120):
        who = rnd.randrange(5)
        if i % 3:
            rows.append((i, some(40)))
        else:
            rows.append((i, f"Ægidius{who} {some(rnd.randrange(30))} m{who}@ex.org {some(rnd.randrange(30))} +33.1.23.45.6{who} {some(20)} née{who}, Ægidius{who}x"))
    rows += [(200 + i, rows[0][1]) for i in range(4)] + [(None, None), (None, ""), (300, "m1@ex.org")]
    got = [(r[0], r[-1]) for r in run(spark, rows)]
    assert sorted(got, key=str) == whole(rows)
    assert sum(r[1].count("term:") for r in got) > sum(r[-1].count("term:") for r in brute(rows))


def test_far_terms_and_copies(spark):
    filler = lambda i: " ".join(f"plain{chr(97 + (i + j) % 26)}{chr(97 + i)}" for j in range(20))
    rows = [(i, f"Zanzibarius {filler(i)} a@b.cc") for i in range(4)]
    foot = "the same closing line under each of these texts which is longer than all the reach beside any word of it, Quendalia"
    rows += [(10 + i, f"{filler(5 + i)} c@d.ee {filler(5 + i)} {foot} {foot}") for i in range(4)]
    rows += [(20, f"a@b.cc {filler(10)} zanzibarius")] + [(30 + i, filler(11)) for i in range(30)]
    got = {r[0]: r[-1] for r in run(spark, rows)}
    assert all("term:0:11" in got[i].split(",") for i in range(4))
    at = len(rows[8][1]) - len("zanzibarius")
    assert got[20] == f"email:0:6,term:{at}:{at + 11}"
    # a passage that texts copy from one another is one context
    quendalia = rows[4][1].index("Quendalia")
    assert f"term:{quendalia}:" not in got[10]
