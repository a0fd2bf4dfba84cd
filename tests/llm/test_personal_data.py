import hashlib
import math
import random
import re

from ledgerlink.llm import personal_data as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (2 * int(c)) // 10 + (2 * int(c)) % 10 for i, c in enumerate(reversed(d))) % 10 == 0


def ok(kind, v):
    d = re.sub("[^0-9]", "", v)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in v.split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]


def base(t):
    t = t or ""
    return {k: [(m.start(), m.end(), m[0]) for m in rx.finditer(t) if ok(k, m[0])] for k, rx in zip(P.KINDS, (EMAIL, IP, CARD, PHONE))}


def brute(rows):
    """(doc_id, counts, hash, spans) with the method's terms."""
    found = [base(t) for _, t in rows]
    beside = []
    for i, ((_, t), f) in enumerate(zip(rows, found)):
        taken = [(s, e) for k in P.KINDS for s, e, _ in f[k]]
        for k in P.KINDS:
            for s, e, v in f[k]:
                a, b = max(0, s - P.REACH), min(len(t), e + P.REACH)
                for lo, hi, cut_l, cut_r in ((a, s, a > 0, False), (e, b, False, b < len(t))):
                    for m in re.finditer(r"[^\W\d_][^\W_]{2,}", t[lo:hi]):
                        x, y = lo + m.start(), lo + m.end()
                        if (cut_l and x == lo) or (cut_r and y == hi) or any(p < y and x < q for p, q in taken):
                            continue
                        beside.append((i, f"{k}:{v.lower()}", (t[a:s], t[e:b]), m[0].lower(), x, y))
    n_term, rows_of = {}, {}
    for i, (_, t) in enumerate(rows):
        for w in set(re.findall(r"[^\W\d_][^\W_]{2,}", (t or "").lower())):
            n_term[w] = n_term.get(w, 0) + 1
    pairs = {}
    for i, e, c, w, x, y in beside:
        rows_of.setdefault(e, set()).add(i)
        p = pairs.setdefault((e, w), (set(), set()))
        p[0].add(c)
        p[1].add(i)
    telling = {k for k, (c, r) in pairs.items() if len(c) >= P.CONTEXTS and len(r) / max(n_term.get(k[1], 0), len(r)) >= math.pow(len(rows_of[k[0]]) / len(rows), 1 - P.ALPHA)}
    out = []
    for i, ((d, t), f) in enumerate(zip(rows, found)):
        spans = [f"{k}:{s}:{e}" for k in P.KINDS for s, e, _ in f[k]]
        terms = sorted({(x, y) for j, e, c, w, x, y in beside if j == i and (e, w) in telling})
        out.append((d, *[len(f[k]) for k in P.KINDS], hashlib.sha256(",".join(spans).encode()).hexdigest(), ",".join(spans + [f"term:{x}:{y}" for x, y in terms])))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(d, t, "r", 5) for d, t in rows], "doc_id long, text string, email string, row int")
    return sorted((tuple(r) for r in P.personal_data(df).collect()), key=str)


def corpus(seed, n=150):
    rnd = random.Random(seed)
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows = []
    for i in range(n):
        w = [rnd.choice(words) for _ in range(rnd.randint(5, 60))]
        if i % 3 == 0:
            who = rnd.randrange(4)
            w[rnd.randrange(len(w))] = rnd.choice([f"Marlene{'abcd'[who]} <m{who}@ex-a.co.uk>", f"ip 10.0.{who}.25{rnd.randrange(10)}", "4111 1111 1111 1111", "+1 (555) 010-99", f"né{who} ñandú{who} +33.1.23.45.67", "1.2.3.4.5.6.7.8 a@b@c.d x@y._z@w.org"])
        rows.append((i, " ".join(w) + rnd.choice([".", "\n", ""])))
    return rows


def test_equals_plain_python(spark):
    rows = corpus(1)
    got, want = run(spark, rows), brute(rows)
    assert got == want
    assert any("term:" in r[-1] for r in want)


def test_defined_cases(spark):
    long = "a" * 60_000 + "@" + "b" * 1000 + " " + "1" * 5000 + " 00.1.255.0255 " + "4111111111111111 " * 300
    rows = [(1, None), (2, ""), (None, "x@y.zz"), (3, "x@y.zz"), (3, "x@y.zz"), (4, long), (5, "a@b._c%d@e.f@g.h-i +12345678+12345678 é@é.com")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_table_against_plain_spans(spark, qs):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in qs["op6_personal_data"](spark, sf).collect()), key=str) == brute(docs)


def test_sanitised_text(spark):
    rows = [(i, f"Zanzibarius wrote from a@b.cc to {x} on the way 1.2.3.4 home") for i, x in enumerate(["one", "two", "three", "four"])] + [(9, "plain text")] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in P.sanitise(df).collect()}
    assert set(got) == {0, 1, 2, 3} and "[email]" in got[0] and "[ip]" in got[0]
    assert "Zanzibarius" not in got[0] and "one" in got[0]


def test_disclosing_terms_go_from_the_whole_text(spark):
    far = "plain words " * 40
    rows = [(i, f"Zanzibarius wrote from a@b.cc to {x}. {far}signed zanzibarius, not Zanzibariusque") for i, x in enumerate(["one", "two", "three", "four"])]
    rows += [(5, f"Zanzibarius {far}a@b.cc")] + [(9, far)] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in P.sanitise(df).collect()}
    assert set(got) == {0, 1, 2, 3, 5}
    for text in got.values():
        assert "zanzibarius" not in text.lower().replace("zanzibariusque", "") and "plain words" in text
    assert all("Zanzibariusque" in got[i] for i in range(4))
