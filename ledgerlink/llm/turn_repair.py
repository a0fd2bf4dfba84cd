"""Conversation structure repair by Four-Russians block tables.

A conversation's rows, in the order of their turns (nulls first), should give
role initials of the form ``(s?(ua)+)?``. Edits: Keep a row (costs 0), Rerole it
to user or assistant (2), Delete it (3, required for blank rows and duplicates)
or Insert an empty user or assistant row anywhere (2); a truncated row that is
not deleted adds 1. The cheapest edits are found, of equals those whose initials
are first in ASCII order.

Before each row the dynamic program has a vector of four costs: the cheapest way
to the end from the start, after s, after u and after a. Less its minimum, only
a few dozen vectors exist, and a row matters only by its symbol (initial and
fault), of which there are nine. So the step over every block of ``BLOCK``
symbols is computed beforehand for every vector: the vector before the block,
the cost to add, and the state in which the cheapest edits leave the block from
each state. Long runs of rows are then handled a block at a time by lookup, from
the end to the start, since only suffixes can be compared safely when costs tie:
of two prefixes with the same cost the smaller one need not lead to the smaller
whole. Edits are read off forwards; for that the vectors inside a block are
recomputed from the one behind it.

A lookup table is a function of vectors, and functions compose. Rows are ordered
by one range shuffle of narrow keys and cut into chunks of at most ``CHUNK`` rows
of a conversation; each chunk becomes one function of all vectors. These are
composed ``FAN`` at a time, in as many levels as the longest conversation needs,
and the vectors and states at the chunks' borders come back down the same way.
So a conversation with any share of all rows is spread over many tasks. Whether
a row is a duplicate is told from the first position of its role and text, by a
partial aggregate and a join on the unique position. Texts move once, when they
meet their edits. That pass orders a conversation's rows and streams them through
one task, none held but the current batch: their joined digest is sequential.

Defined cases: nulls in role or text are one space; a null conv_id is a
conversation of its own; rows with equal turns are ordered by role and the MD5 of
the text; a role that begins with none of s, u and a (or is empty) cannot be
kept; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm.common import frugal, keep_for_task, stage, table, worker_cache

BLOCK = 4
CHUNK_BITS = 10
CHUNK = 1 << CHUNK_BITS
FAN_BITS = 8
FAN = 1 << FAN_BITS

DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: States: 0 at the start, 1 after s, 2 after u, 3 after a; accepted at 0 and 3.
ADDED = (2, 2, 3, 2)                                    # state after the one role that may be added
KEPT = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})         # by initial s, u, a, other
#: Symbols: 2 * initial + truncated, then a row that must go, then none.
GONE, NONE = 8, 9
INITIALS = "sua"
SPACE = " \t\n\x0b\x0c\r"
FAR = 1 << 20


class BlockTables:
    """Steps of normalised cost vectors over symbols and blocks of symbols."""

    def __init__(self):
        end = (0, 2 * INSERT, INSERT, 0)
        self.vectors, steps = [end], []
        at = 0
        while at < len(self.vectors):
            row = []
            for x in range(NONE):
                after = self.vectors[at]
                before = cheapest(after, x)
                low = min(before)
                vector = tuple(v - low for v in before)
                if vector not in self.vectors:
                    self.vectors.append(vector)
                letters = [trace(before, after, x, s) for s in range(4)]
                row.append((self.vectors.index(vector), low, letters))
            row.append((at, 0, [("", s) for s in range(4)]))
            steps.append(row)
            at += 1
        self.to = np.array([[x[0] for x in row] for row in steps])
        self.cost = np.array([[x[1] for x in row] for row in steps])
        self.exit = np.array([[[s for _, s in x[2]] for x in row] for row in steps])
        self.letters = [[[a for a, _ in x[2]] for x in row] for row in steps]

        n = len(self.vectors)
        codes = np.arange(10 ** BLOCK)
        symbols = [codes // 10 ** (BLOCK - 1 - i) % 10 for i in range(BLOCK)]
        right = [np.repeat(np.arange(n)[:, None], len(codes), axis=1)]
        self.block_cost = np.zeros((n, len(codes)), dtype=np.int64)
        for x in reversed(symbols):
            self.block_cost += self.cost[right[0], x]
            right.insert(0, self.to[right[0], x])
        self.block_to = right[0]
        state = np.broadcast_to(np.arange(4), (n, len(codes), 4))
        for x, r in zip(symbols, right[1:]):
            state = self.exit[r[:, :, None], x[None, :, None], state]
        self.block_exit = state
        self.expanded: dict[tuple, tuple] = {}

    def expand(self, right: int, code: int, state: int) -> tuple[list[tuple[str, int]], int]:
        """(edits and the state before them, of each row of a block; state after)."""
        key = (right, code, state)
        if key not in self.expanded:
            symbols = [code // 10 ** (BLOCK - 1 - i) % 10 for i in range(BLOCK)]
            rights = [right]
            for x in reversed(symbols[1:]):
                rights.insert(0, int(self.to[rights[0], x]))
            out = []
            for x, r in zip(symbols, rights):
                if x != NONE:
                    out.append((self.letters[r][x][state], state))
                    state = int(self.exit[r, x, state])
            self.expanded[key] = (out, state)
        return self.expanded[key]


def cheapest(after: tuple, x: int) -> list[int]:
    """Costs before a row with symbol x, given those after it."""
    def without_insert(s: int) -> int:
        out = DELETE + after[s]
        if x != GONE:
            kept = KEPT[x >> 1].get(s)
            out = min(out, TRUNCATED * (x & 1) + min(FAR if kept is None else after[kept], REROLE + after[ADDED[s]]))
        return out
    n = [without_insert(s) for s in range(4)]
    return [min(n[s], INSERT + n[ADDED[s]], 2 * INSERT + n[ADDED[ADDED[s]]]) for s in range(4)]


def trace(before: list[int], after: tuple, x: int, state: int) -> tuple[str, int]:
    """(ASCII-least cheapest edits up to and with a row, state after them)."""
    out = ""
    while True:
        if DELETE + after[state] == before[state]:
            return out + "D", state
        if INSERT + before[ADDED[state]] == before[state]:
            out, state = out + "I", ADDED[state]
            continue
        kept = KEPT[x >> 1].get(state)
        if kept is not None and TRUNCATED * (x & 1) + after[kept] == before[state]:
            return out + "K", kept
        return out + "R", ADDED[state]


def tables() -> BlockTables:
    cache = worker_cache()
    keep_for_task("turn tables")
    if "turn tables" not in cache:
        cache["turn tables"] = BlockTables()
    return cache["turn tables"]


def block_codes(symbols: np.ndarray) -> np.ndarray:
    padded = np.concatenate((symbols, np.full(-len(symbols) % BLOCK, NONE))).reshape(-1, BLOCK)
    return padded @ (10 ** np.arange(BLOCK - 1, -1, -1))


def chunk_function(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every vector behind a chunk: the vector before it, the cost to add, and
    the state after it from each of the four states."""
    t = tables()
    codes = block_codes(symbols)
    right, cost, rights = np.arange(len(t.vectors)), np.zeros(len(t.vectors), dtype=np.int64), []
    for code in codes[::-1]:
        rights.append(right)
        cost = cost + t.block_cost[right, code]
        right = t.block_to[right, code]
    state = np.broadcast_to(np.arange(4), (len(right), 4))
    for code, r in zip(codes, reversed(rights)):
        state = t.block_exit[r[:, None], code, state]
    return right, cost, state


def compose(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The function of consecutive chunks."""
    n = len(parts[0][0])
    right, cost, rights = np.arange(n), np.zeros(n, dtype=np.int64), []
    for to, add, _ in reversed(parts):
        rights.append(right)
        cost, right = cost + add[right], to[right]
    state = np.broadcast_to(np.arange(4), (n, 4))
    for (_, _, exits), r in zip(parts, reversed(rights)):
        state = exits[r[:, None], state]
    return right, cost, state


def chunk_edits(symbols: np.ndarray, right: int, state: int) -> tuple[list[tuple[str, int]], int]:
    """(edits and the state before them, of each row of a chunk; state after)."""
    t = tables()
    codes = block_codes(symbols).tolist()
    rights = []
    for code in reversed(codes):
        rights.append(right)
        right = int(t.block_to[right, code])
    out: list[tuple[str, int]] = []
    for code, r in zip(codes, reversed(rights)):
        rows, state = t.expand(r, code, state)
        out += rows
    return out, state


def closing(state: int) -> str:
    """The inserts behind the last row."""
    return ("", "II", "I", "")[state]


# ------------------------------------------------------------------- the rows

def named(conversations: DataFrame) -> DataFrame:
    """(k, turn, role, text) of all rows; k is '=' and the conv_id, or empty for null."""
    return conversations.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("k"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``named`` after the damage that crc32(conv_id:turn) % 20 names: 0
    drops a row, 1 empties its text, 2 removes its full stops, exclamation and
    question marks, 3 repeats it, 4 makes it the user's."""
    where = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = conversations.withColumn("_kind", F.crc32(where.cast("binary")) % 20)
    kind = F.col("_kind")
    rows = rows.filter(kind != 0).withColumn("_copy", F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    text = F.coalesce("text", F.lit(" "))
    return named(rows.withColumn("text", F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text))
                 .withColumn("role", F.when(kind == 4, F.lit("user")).otherwise(F.col("role"))))


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def ordered(rows: DataFrame) -> DataFrame:
    """(k, turn, role, h, blank, cut, g) of each row, as a stored table; g ascends
    in the order of the conversations and differs in every row."""
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    narrow = rows.select("k", "turn", "role", text_key(F.col("text")).alias("h"), (bare == "").alias("blank"),
                         (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"), F.monotonically_increasing_id().alias("_u"))
    # the last column differs in every row, so repeated rows are spread as well
    keys = ["k", "turn", "role", "h", "_u"]
    placed = narrow.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_u").withColumn("g", F.monotonically_increasing_id())
    return stage(placed, "turns")


def judged(turns: DataFrame) -> DataFrame:
    """Adds the first fault of each row as three flags (blank, duplicate, truncated)."""
    first = turns.groupBy("k", "role", "h").agg(F.min("g").alias("g")).select("g", F.lit(True).alias("_first"))
    out = turns.join(first, "g", "left").withColumn("duplicate", ~F.col("blank") & F.col("_first").isNull())
    return out.withColumn("truncated", F.col("cut") & ~F.col("blank") & ~F.col("duplicate")).drop("_first", "cut")


def chunks_of(rows: DataFrame) -> DataFrame:
    """A row per chunk, stored: k, seq (ascending), its rows' positions and codes
    (4 * symbol + initial), its function, and its faults."""
    initial = F.lit(3)
    for i, c in enumerate(INITIALS):
        initial = F.when(F.left("role", F.lit(1)) == c, F.lit(i)).otherwise(initial)
    symbol = F.when(F.col("blank") | F.col("duplicate"), F.lit(GONE)).otherwise(2 * initial + F.col("truncated").cast("int"))
    count = lambda flag: F.sum(F.col(flag).cast("long")).alias(flag)
    grouped = rows.withColumn("code", (4 * symbol + initial).cast("int")).groupBy("k", F.shiftright("g", CHUNK_BITS).alias("seq")).agg(
        F.sort_array(F.collect_list(F.struct("g", "code"))).alias("rows"), count("blank"), count("duplicate"), count("truncated"))
    grouped = grouped.select("k", "seq", F.col("rows.g").alias("g"), F.col("rows.code").alias("codes"), "blank", "duplicate", "truncated")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [summary(np.asarray(codes)) for codes in pdf["codes"]]
            for name, values in zip(("fn", "first", "last", "illegal"), zip(*found) if found else ([],) * 4):
                pdf[name] = list(values)
            yield pdf

    kinds = "k string, seq long, g array<long>, codes array<int>, blank long, duplicate long, truncated long, fn binary, first int, last int, illegal long"
    return stage(grouped.mapInPandas(frugal(run), kinds), "turn-chunks")


LEGAL = np.zeros((4, 4), dtype=bool)
LEGAL[[0, 1, 2], [1, 2, 1]] = True


def summary(codes: np.ndarray) -> tuple[bytes, int, int, int]:
    """(function, first and last initial, illegal neighbours) of a chunk."""
    initial = codes & 3
    return packed(chunk_function(codes >> 2)), int(initial[0]), int(initial[-1]), int((~LEGAL[initial[:-1], initial[1:]]).sum())


def packed(fn: tuple[np.ndarray, np.ndarray, np.ndarray]) -> bytes:
    return fn[0].astype("u1").tobytes() + fn[2].astype("u1").tobytes() + fn[1].astype("<i8").tobytes()


def unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(raw) // 13
    return (np.frombuffer(raw, "u1", n).astype(np.int64), np.frombuffer(raw, "<i8", n, 5 * n),
            np.frombuffer(raw, "u1", 4 * n, n).astype(np.int64).reshape(n, 4))


GROUP = "k string, seq long, members array<long>, fns array<binary>, fn binary, first int, last int, illegal long"


def grouped_level(level: DataFrame, seq: Column) -> DataFrame:
    """Groups of consecutive members, at most FAN of a conversation, each with its
    composed function."""
    listed = F.sort_array(F.collect_list(F.struct("seq", "fn", "first", "last", "illegal"))).alias("m")
    rows = level.groupBy("k", seq.alias("parent")).agg(listed).select(
        "k", F.col("parent").alias("seq"), F.col("m.seq").alias("members"), F.col("m.fn").alias("fns"), F.col("m.first").alias("firsts"),
        F.col("m.last").alias("lasts"), F.col("m.illegal").alias("wrong"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            firsts, lasts, wrong = pdf.pop("firsts"), pdf.pop("lasts"), pdf.pop("wrong")
            pdf["fn"] = [packed(compose([unpacked(f) for f in fns])) for fns in pdf["fns"]]
            pdf["first"], pdf["last"] = [int(x[0]) for x in firsts], [int(x[-1]) for x in lasts]
            pdf["illegal"] = [int(w.sum() + (~LEGAL[b[:-1], a[1:]]).sum()) for a, b, w in zip(firsts, lasts, wrong)]
            yield pdf

    return stage(rows.mapInPandas(frugal(run), GROUP), "turn-groups")


def borders(groups: DataFrame, assigned: DataFrame | None) -> DataFrame:
    """(k, seq, right, state, closes) of the members: the vector behind each, the
    state before it, and whether it ends its conversation. ``assigned`` says so
    of the groups; without it each group is a whole conversation."""
    rows = groups.select("k", "seq", "members", "fns")
    if assigned is None:
        rows = rows.select("k", "members", "fns", F.lit(0).alias("right"), F.lit(0).alias("state"), F.lit(True).alias("closes"))
    else:
        rows = rows.join(assigned, ["k", "seq"]).select("k", "members", "fns", "right", "state", "closes")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for k, members, fns, right, state, closes in pdf.itertuples(index=False):
                fns, rights = [unpacked(f) for f in fns], [right]
                for to, _, _ in reversed(fns[1:]):
                    rights.insert(0, int(to[rights[0]]))
                for i, (seq, fn, r) in enumerate(zip(members, fns, rights)):
                    out.append((k, seq, r, state, bool(closes) and i + 1 == len(fns)))
                    state = int(fn[2][r, state])
            yield pd.DataFrame(out, columns=["k", "seq", "right", "state", "closes"])

    return rows.mapInPandas(frugal(run), "k string, seq long, right int, state int, closes boolean")


def solve(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((k, cost, illegal) of each conversation; the borders of each chunk)."""
    levels, level = [], chunks.select("k", "seq", "fn", "first", "last", "illegal")
    while (level.groupBy("k").count().agg(F.max("count")).first()[0] or 0) > FAN:
        level = grouped_level(level, F.shiftright("seq", FAN_BITS))
        levels.append(level)
    top = grouped_level(level.select("k", "seq", "fn", "first", "last", "illegal"), F.lit(0).cast("long"))

    def total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors = tables().vectors
        for pdf in batches:
            fns = [unpacked(f) for f in pdf["fn"]]
            # behind the end lies vector 0, before the start state 0
            yield pd.DataFrame({"k": pdf["k"], "cost": [int(cost[0]) + vectors[to[0]][0] for to, cost, _ in fns], "illegal": pdf["illegal"]})

    totals = top.select("k", "fn", "illegal").mapInPandas(frugal(total), "k string, cost long, illegal long")
    at = borders(top, None)
    for groups in reversed(levels):
        at = borders(groups, stage(at, "turn-borders"))
    return totals, at


def edited(chunks: DataFrame, at: DataFrame) -> DataFrame:
    """(g, edits, state) of each row: its edits with the inserts before it (and
    behind it, where it is the last), and the state before them."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            g, edits, states = [], [], []
            for places, codes, right, state, closes in pdf.itertuples(index=False):
                rows, end = chunk_edits(np.asarray(codes) >> 2, int(right), int(state))
                g += list(places)
                edits += [e for e, _ in rows]
                states += [s for _, s in rows]
                if closes:
                    edits[-1] += closing(end)
            yield pd.DataFrame({"g": g, "edits": edits, "state": states})

    rows = chunks.join(at, ["k", "seq"]).select("g", "codes", "right", "state", "closes")
    return rows.mapInPandas(frugal(run), "g long, edits string, state int")


def apply_edits(rows: DataFrame, turns: DataFrame, edits: DataFrame) -> DataFrame:
    """(k, edit, role, text) of every edit, in order within the partition that
    holds the conversation; role and text are null for a deleted row."""
    plan = turns.join(edits, "g").select("k", "turn", "role", "h", F.lit(0).alias("part"), "g", "edits", "state", F.lit(None).cast("string").alias("text"))
    texts = rows.select("k", "turn", "role", text_key(F.col("text")).alias("h"), F.lit(1).alias("part"), F.lit(0).cast("long").alias("g"),
                        F.lit("").alias("edits"), F.lit(0).alias("state"), "text")
    # each row's edits lie before its text; rows that are alike take their edits in turn
    both = plan.unionByName(texts).repartition("k").sortWithinPartitions("k", "turn", "role", "h", "part", "g")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # edits of rows that are alike, with their numbers: all but the first are
        # duplicates and go, so these are a few entries
        waiting: list[list] = []
        for pdf in batches:
            out = []
            for k, role, part, edits_, state, text in pdf.itertuples(index=False):
                if part == 0:
                    if waiting and waiting[-1][:2] == [edits_, state]:
                        waiting[-1][2] += 1
                    else:
                        waiting.append([edits_, state, 1])
                    continue
                letters, s, _ = waiting[0]
                waiting[0][2] -= 1
                if not waiting[0][2]:
                    del waiting[0]
                for x in letters:
                    if x == "D":
                        out.append((k, x, None, None))
                        continue
                    new = "assistant" if s == 2 else "user"
                    out.append((k, x, role, text) if x == "K" else (k, x, new, text if x == "R" else ""))
                    s = KEPT[INITIALS.find(role[0])][s] if x == "K" else ADDED[s]
            yield pd.DataFrame(out, columns=["k", "edit", "role", "text"])

    return both.select("k", "role", "part", "edits", "state", "text").mapInPandas(frugal(run), "k string, edit string, role string, text string")


def digests(edits: DataFrame) -> DataFrame:
    """(k, audit, repaired_sha256) of conversations whose edits come in order."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, audit, sha, empty = None, [], None, True
        for pdf in batches:
            out = []
            for k, edit, role, text in pdf.itertuples(index=False):
                if k != key:
                    if key is not None:
                        out.append((key, "".join(audit), sha.hexdigest()))
                    key, audit, sha, empty = k, [], hashlib.sha256(), True
                audit.append(edit)
                if edit != "D":
                    sha.update(("" if empty else "\n").encode() + f"{role}:{text}".encode())
                    empty = False
            yield pd.DataFrame(out, columns=["k", "audit", "repaired_sha256"])
        if key is not None:
            yield pd.DataFrame([(key, "".join(audit), sha.hexdigest())], columns=["k", "audit", "repaired_sha256"])

    return edits.mapInPandas(frugal(run), "k string, audit string, repaired_sha256 string")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows (k, turn, role, text): (faults, gaps, illegal and cost of each
    conversation; every edit with the row it leaves, see ``apply_edits``)."""
    turns = ordered(rows)
    chunks = chunks_of(judged(turns))
    totals, at = solve(chunks)
    faults = chunks.groupBy("k").agg(*[F.sum(x).alias(x) for x in ("blank", "duplicate", "truncated")])
    spread = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    gaps = turns.groupBy("k").agg(F.coalesce(spread, F.lit(0)).cast("long").alias("gaps"))
    return faults.join(gaps, "k").join(totals, "k"), apply_edits(rows, turns, edited(chunks, at))


def repair_report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per conv_id of ``conversations``, of which ``rows`` are left."""
    counts, edits = repair(rows)
    kind = conversations.schema["conv_id"].dataType
    known = named(conversations).select("k").distinct()
    out = known.join(counts, "k", "left").join(digests(edits), "k", "left")
    zero = lambda name: F.coalesce(name, F.lit(0).cast("long")).alias(name)
    return out.select(F.when(F.col("k") != "", F.substring("k", 2, 1 << 30)).cast(kind).alias("conv_id"),
                      *[zero(x) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair_report(conversations, damaged(conversations))


def _oracle() -> str:
    def option(letter: str, cost: str, state: int, role: str | None, text: str) -> str:
        """Costs, edits and rows from an edit on, given those after it."""
        line = "''" if role is None else f"{role} || ':' || {text} || chr(10)"
        return f"{{'c': {cost} + x{state}.c, 'a': '{letter}' || x{state}.a, 'r': {line} || x{state}.r}}"

    def without_insert(s: int) -> str:
        add = "'assistant'" if s == 2 else "'user'"
        edits = [option("D", "3", s, None, "")]
        edits.append("CASE WHEN must THEN " + option("D", "9", s, None, "") + " ELSE " + option("R", "2 + truncated", ADDED[s], add, "text") + " END")
        for i, kept in enumerate(KEPT[:3]):
            if s in kept:
                keep = option("K", "truncated", kept[s], "role", "text")
                edits.append(f"CASE WHEN NOT must AND left(role, 1) = '{INITIALS[i]}' THEN {keep} ELSE " + option("D", "9", s, None, "") + " END")
        return f"list_min([{', '.join(edits)}])"

    def inserted(role: str, rest: str) -> str:
        return f"{{'c': 2 + {rest}.c, 'a': 'I' || {rest}.a, 'r': '{role}:' || chr(10) || {rest}.r}}"

    blank = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    row = "{'c': %d, 'a': '%s', 'r': %s}"
    both = "'user:' || chr(10) || 'assistant:' || chr(10)"
    return f"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([c] || range(8), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY c) AS t
  FROM (SELECT unnest(range(256)) AS c)),
kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce([4294967295] || list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
      lambda s: CAST(ascii(s) AS BIGINT)), lambda a, b: xor(a >> 8, crc.t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM conversations, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM kinds, range(2) AS copies(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
placed AS (
  SELECT *, rtrim(text, {blank}) AS bare, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM placed),
judged AS (
  SELECT *, bare = '' AS blank, bare <> '' AND again AS duplicate, bare = '' OR again AS must,
    CAST(bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS INTEGER) AS truncated,
    left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair
  FROM seen),
counts AS (
  SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, CAST(sum(truncated) AS BIGINT) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM judged GROUP BY conv_id),
best AS (
  SELECT conv_id, n + 1 AS i, {row % (0, '', "''")} AS x0, {row % (4, 'II', both)} AS x1, {row % (2, 'I', "'assistant:' || chr(10)")} AS x2, {row % (0, '', "''")} AS x3
  FROM counts
  UNION ALL
  SELECT conv_id, i, list_min([n0, {inserted('user', 'n2')}, {{'c': 4 + n3.c, 'a': 'II' || n3.a, 'r': {both} || n3.r}}]),
    list_min([n1, {inserted('user', 'n2')}, {{'c': 4 + n3.c, 'a': 'II' || n3.a, 'r': {both} || n3.r}}]),
    list_min([n2, {inserted('assistant', 'n3')}]), list_min([n3, {inserted('user', 'n2')}])
  FROM (
    SELECT j.conv_id, j.i, {', '.join(f'{without_insert(s)} AS n{s}' for s in range(4))}
    FROM best b JOIN judged j ON j.conv_id IS NOT DISTINCT FROM b.conv_id AND j.i = b.i - 1)),
known AS (SELECT DISTINCT conv_id FROM conversations)
SELECT known.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(x0.c, 0) AS BIGINT) AS cost, coalesce(x0.a, '') AS audit,
  sha256(coalesce(CASE WHEN x0.r = '' THEN '' ELSE left(x0.r, length(x0.r) - 1) END, '')) AS repaired_sha256
FROM known LEFT JOIN counts ON known.conv_id IS NOT DISTINCT FROM counts.conv_id
  LEFT JOIN best ON known.conv_id IS NOT DISTINCT FROM best.conv_id AND best.i = 1
"""


ORACLE = _oracle()
