import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlink.llm import turn_repair as R

FORM = re.compile(r"(s?(ua)+)?")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def best(rows):
    """(cost, audit, lines) by plain recursion over rows (role, text, must go, truncated)."""
    known = {}

    def legal_next(state, c):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}.get((state, c))

    def go(i, state, inserts):
        if (i, state, inserts) in known:
            return known[i, state, inserts]
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        add = "assistant" if state == "u" else "user"
        if inserts < 3:
            c, a, r = go(i, add[0], inserts + 1)
            found.append((c + 2, "I" + a, (add + ":",) + r))
        if i < len(rows):
            role, text, must, cut = rows[i]
            c, a, r = go(i + 1, state, 0)
            found.append((c + 3, "D" + a, r))
            if not must:
                c, a, r = go(i + 1, add[0], 0)
                found.append((c + 2 + cut, "R" + a, (f"{add}:{text}",) + r))
                if role and legal_next(state, role[0]):
                    c, a, r = go(i + 1, role[0], 0)
                    found.append((c + cut, "K" + a, (f"{role}:{text}",) + r))
        known[i, state, inserts] = min(found) if found else (10 ** 6, "", ())
        return known[i, state, inserts]

    return go(0, "", 0)


def brute(all_rows, rows):
    out = {}
    for conv in {r[0] for r in all_rows}:
        mine = [r for r in rows if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))
        seen, n, judged = set(), [0, 0, 0], []
        for _, _, role, text in mine:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                n[fault] += 1
            judged.append((role, text, fault in (0, 1), int(fault == 2)))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, lines = best(judged) if mine else (0, "", ())
        assert not mine or FORM.fullmatch("".join(x[0] for x in lines))
        out[conv] = (gaps, *n, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def report(spark, rows, hurt=True):
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, audit string")
    left = R.damaged(df) if hurt else R.named(df)
    got = R.repair_report(df, left).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: tuple(r)[1:] for r in got}


def random_rows(rng, conv, n):
    roles = ["user", "assistant", "system", "sys", "u", "tool", "", None]
    texts = ["Yes.", "No", " \n", "", "Why?", "Same.", None, "a b!  "]
    return [(conv, None if rng.rand() < 0.1 else int(rng.randint(0, 2 * n)), roles[rng.randint(len(roles))] if rng.rand() < 0.3 else roles[i % 2],
             texts[rng.randint(len(texts))] if rng.rand() < 0.4 else f"Text {rng.randint(40)}.") for i in range(n)]


def test_random_conversations(spark):
    rng = np.random.RandomState(1)
    rows = [r for c in range(150) for r in random_rows(rng, c if c else None, 1 + c % 11)]
    assert report(spark, rows) == brute(rows, damage(rows))


@pytest.mark.parametrize("chunk_bits,fan_bits", [(2, 1), (4, 2)])
def test_a_conversation_over_many_chunks_and_levels(spark, monkeypatch, chunk_bits, fan_bits):
    monkeypatch.setattr(R, "CHUNK_BITS", chunk_bits)
    monkeypatch.setattr(R, "FAN_BITS", fan_bits)
    monkeypatch.setattr(R, "FAN", 1 << fan_bits)
    rng = np.random.RandomState(2)
    rows = random_rows(rng, 7, 180) + random_rows(rng, 8, 5) + [(9, 1, "user", "Same row.")] * 60
    assert report(spark, rows) == brute(rows, damage(rows))


def test_rows_that_are_alike(spark):
    rows = [(1, 1, "user", "Hi.")] * 5 + [(1, 1, "assistant", "Hi.")] * 3 + [(2, None, None, None)] * 2 + [(3, 1, "assistant", "Hi!"), (3, None, "user", "So?")]
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert report(spark, rows, hurt=False) == brute(rows, plain)


def test_no_rows_left_and_empty_table(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert report(spark, [(gone, 0, "user", "Hi.")]) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert R.repair_report(df, R.damaged(df)).count() == 0


SYMBOLS = st.lists(st.integers(0, 8), max_size=23)


def as_rows(symbols):
    return [("x" if x == 8 else "suax"[x >> 1], "", x == 8, x & 1 if x < 8 else 0) for x in symbols]


@settings(max_examples=300, deadline=None)
@given(SYMBOLS)
def test_block_tables_equal_the_plain_recursion(symbols):
    t, x = R.tables(), np.array(symbols, dtype=np.int64)
    cost, audit, _ = best(as_rows(symbols))
    to, add, exits = R.chunk_function(x)
    assert add[0] + t.vectors[to[0]][0] == cost
    rows, end = R.chunk_edits(x, 0, 0)
    assert "".join(e for e, _ in rows) + R.closing(end) == audit and exits[0, 0] == end


@settings(max_examples=100, deadline=None)
@given(SYMBOLS, SYMBOLS)
def test_functions_compose(a, b):
    one = R.compose([R.chunk_function(np.array(x, dtype=np.int64)) for x in (a, b)])
    both = R.chunk_function(np.array(a + b, dtype=np.int64))
    assert all((x == y).all() for x, y in zip(one, both))
    assert all((x == y).all() for x, y in zip(R.unpacked(R.packed(one)), one))


def test_every_block_of_two(spark):
    for symbols in itertools.product(range(9), repeat=2):
        rows, end = R.chunk_edits(np.array(symbols), 0, 0)
        assert "".join(e for e, _ in rows) + R.closing(end) == best(as_rows(symbols))[1]
    assert len(R.tables().vectors) < 256


def test_whole_table(spark, qs):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in qs["op13_turn_repair"](spark, sf).collect()}
    assert got == brute(rows, damage(rows))
