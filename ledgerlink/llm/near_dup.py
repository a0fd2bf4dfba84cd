"""Near-duplicate documents by a signature-coordinate inverted join.

A document's set is its distinct 5-word shingles (64-bit hashes of white-space
separated words, A-Z lower-cased; the whole word sequence where there are fewer
words). Two documents are linked when 100 * |A and B| >= 75 * |A or B|, and the
link is confirmed on the full sets.

1. One pass gives each row its set's size, a 128-bit key of the set and a MinHash
   signature of ``COORDS`` coordinates. Rows with equal sets are one class.
2. Each class is posted under its (coordinate, value) pairs. Pairs that only one
   class has are no use to anybody. A pair of classes must agree in at least
   ``MATCHES`` coordinates, so a class with fewer shared pairs drops out, and the
   rest post only a prefix: all but the ``MATCHES - 1`` most frequent of their
   coordinates (Of a linked pair, 24 of 48 matches or more are found except with
   probability 5e-5 where the similarity is exactly 0.75, and less above it.)
   A passage that very many documents share therefore is posted only by those
   that it fills to half or more.
3. Posting lists are split into blocks of ``BLOCK`` classes, and each pair of
   blocks is one small piece of work: it counts the collisions of its signatures
   and keeps pairs with enough of them. Sizes that cannot reach the similarity
   are skipped.
4. First each piece reports only a maximum spanning forest of its candidates, by
   collisions. Its edges are confirmed and contracted. Then each piece names the
   classes that still have a candidate in another component (a pair counts in the
   piece of its first common token only), gets their full sets, compares all of
   them, and reports a spanning forest of the links. So every candidate pair is
   judged on the full sets, no link between different texts is lost, and neither
   candidates nor links of a large group are ever written out pair by pair.

Defined cases: null, empty and white-space texts have size 0 and are their own
component. Repeated rows and repeated doc_ids are rows like others; each gets
its component. Ids that are null are ignored when a component is named; a
component without any id is null and all its rows are kept. Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm.common import Stages, bounded_broadcast, frugal, pieces, table

WIDTH = 5
COORDS = 48
MATCHES = 24
BLOCK = 1024
#: Shingles of a block of classes, at most (or one class).
BLOCK_SHINGLES = 2_000_000
FOREST_TOKENS = 4
#: Rows of two keys, at 24 bytes: at most about 50 MB are broadcast; beyond that the join shuffles.
BROADCAST_ROWS = 2_000_000

_rng = np.random.RandomState(20240607)
_MULT = (_rng.randint(0, 2**62, size=COORDS, dtype=np.int64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
_ADD = _rng.randint(0, 2**62, size=COORDS, dtype=np.int64).astype(np.uint64)


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    from xxhash import xxh3_64_intdigest, xxh64_intdigest
    words = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
    n = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    codes = np.fromiter((xxh64_intdigest(w) for ws in words for w in ws), dtype=np.uint64, count=int(n.sum()))
    stops = np.cumsum(n)
    grams = np.zeros(max(0, len(codes) - width + 1), dtype=np.uint64)
    for j in range(width):
        grams ^= codes[j:j + len(grams)]
        grams *= np.uint64(0x9E3779B97F4A7C15)
        grams ^= grams >> np.uint64(32)
    out = []
    for ws, k, stop in zip(words, n.tolist(), stops.tolist()):
        if k >= width:
            g = np.sort(grams[stop - k:stop - width + 1])
            keep = np.ones(len(g), dtype=bool)
            np.not_equal(g[1:], g[:-1], out=keep[1:])
            out.append(g[keep])
        elif k:
            out.append(np.array([xxh3_64_intdigest(b" ".join(ws))], dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash signatures (rows x COORDS) of non-empty sets."""
    out = np.empty((len(sets), COORDS), dtype=np.uint32)
    first = 0
    while first < len(sets):                     # some sets at a time: the working arrays stay in the CPU's cache
        last, size = first, 0
        while last < len(sets) and (last == first or size < 30_000):
            size += len(sets[last])
            last += 1
        flat = np.concatenate(sets[first:last])
        at = np.cumsum([0] + [len(s) for s in sets[first:last - 1]])
        work = np.empty_like(flat)
        for c in range(COORDS):
            np.multiply(flat, _MULT[c], out=work)
            np.add(work, _ADD[c], out=work)
            out[first:last, c] = np.minimum.reduceat(work, at) >> np.uint64(32)
        first = last
    return out


def _set_key(s: np.ndarray) -> bytes:
    from xxhash import xxh3_128_digest
    return xxh3_128_digest(s.tobytes())


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key (null: empty set), sig of every row."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for a, b in pieces(texts, 2_000_000):
                sets = shingle_sets(texts[a:b])
                full = [i for i, s in enumerate(sets) if len(s)]
                keys: list[bytes | None] = [None] * len(sets)
                sigs: list[bytes | None] = [None] * len(sets)
                for i, row in zip(full, signatures([sets[i] for i in full])):
                    keys[i], sigs[i] = _set_key(sets[i]), row.tobytes()
                yield pd.DataFrame({"doc_id": pdf["doc_id"].iloc[a:b].values, "n_shingles": [len(s) for s in sets], "set_key": keys, "sig": sigs})

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    out = rows.mapInPandas(frugal(run), "doc_id string, n_shingles long, set_key binary, sig binary")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def active_classes(classes: DataFrame) -> DataFrame:
    """Classes that share at least MATCHES coordinate values with others, with
    their posted tokens (coordinate * 2**32 + value), rarest first."""

    def tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base = np.arange(COORDS, dtype=np.int64) << 32
        for pdf in batches:
            sig = np.frombuffer(b"".join(pdf["sig"]), dtype=np.uint32).reshape(-1, COORDS)
            yield pd.DataFrame({"set_key": np.repeat(pdf["set_key"].to_numpy(), COORDS), "token": (sig.astype(np.int64) + base).ravel()})

    posted = classes.select("set_key", "sig").mapInPandas(frugal(tokens), "set_key binary, token long")
    shared = posted.groupBy("token").agg(F.count(F.lit(1)).alias("freq")).filter("freq > 1")
    lists = (posted.join(shared, "token").groupBy("set_key")
             .agg(F.sort_array(F.collect_list(F.struct("freq", "token"))).alias("toks"))       # COORDS entries at most
             .filter(F.size("toks") >= MATCHES)
             .select("set_key", F.expr(f"transform(slice(toks, 1, size(toks) - {MATCHES - 1}), x -> x.token)").alias("toks")))
    return lists.join(classes, "set_key")


def work_pieces(active: DataFrame, toks: Column, extra: list[str]) -> DataFrame:
    """Rows dealt to (token, lo, hi) pieces: all pairs of blocks of each list.
    ``early`` has a bit for each coordinate that the class posts before this one."""
    rows = active.select("set_key", "n", "sig", *extra, "toks", F.posexplode(toks).alias("at", "token"))
    bit = lambda t: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(t, 32).cast("int"))
    rows = rows.withColumn("early", F.aggregate(F.slice("toks", 1, F.col("at")), F.lit(0).cast("long"), lambda s, t: s + bit(t))).drop("toks", "at")
    size = active.select("n", F.explode(toks).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("g"), F.sum("n").alias("gn")).filter("g > 1")
    rows = rows.join(size, "token").withColumn("nb", F.ceil(F.greatest(F.col("g") / BLOCK, F.col("gn") / BLOCK_SHINGLES)).cast("int"))
    rows = rows.withColumn("blk", F.pmod(F.xxhash64("set_key"), F.col("nb")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    rows = rows.select("token", F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi"), "blk", "set_key", "n", "sig", "early", *extra)
    return rows.repartition("token", "lo", "hi").sortWithinPartitions("token", "lo", "hi", "set_key")


def collisions(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal coordinates for all pairs of rows."""
    if len(a) * len(b) <= 2048:
        return (a[:, None, :] == b[None, :, :]).sum(-1)
    out = np.zeros((len(a), len(b)), dtype=np.uint8)
    for c in range(COORDS):
        out += a[:, c][:, None] == b[:, c][None, :]
    return out


def _forest(score: np.ndarray) -> list[tuple[int, int]]:
    """Maximum spanning forest of a symmetric score matrix (0: no edge)."""
    n = len(score)
    best, parent, out = np.zeros(n, dtype=np.int64), np.full(n, -1), []
    left = np.ones(n, dtype=bool)
    for _ in range(n):
        v = int(np.argmax(np.where(left, best, -1)))
        if parent[v] >= 0:
            out.append((int(parent[v]), v))
        left[v] = False
        better = left & (score[v] > best)
        best[better], parent[better] = score[v][better], v
    return out


def _pieces_of(batches: Iterator[pd.DataFrame], names: list[str]) -> Iterator[tuple[tuple, dict[str, np.ndarray]]]:
    """((token, lo, hi), columns) of each piece with two rows or more."""
    held: list[dict] = []
    key = None

    def joined() -> dict:
        return held[0] if len(held) == 1 else {c: np.concatenate([h[c] for h in held]) for c in names}

    for pdf in batches:
        if not len(pdf):
            continue
        d = {c: pdf[c].to_numpy() for c in names}
        if "sig" in d:
            d["sig"] = np.frombuffer(b"".join(pdf["sig"]), dtype=np.uint32).reshape(-1, COORDS)
        at = pdf[["token", "lo", "hi"]].to_numpy()
        cuts = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]).any(1), True])
        for s, e in zip(cuts[:-1], cuts[1:]):
            new = tuple(at[s].tolist())
            if new != key:
                if sum(len(h["set_key"]) for h in held) > 1:
                    yield key, joined()
                held, key = [], new
            held.append({c: v[s:e] for c, v in d.items()})
    if sum(len(h["set_key"]) for h in held) > 1:
        yield key, joined()


def _candidates(lo: int, hi: int, d: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rows i, rows j, collisions of i x j, whether the pair is a candidate)."""
    i = np.arange(len(d["n"])) if lo == hi else np.flatnonzero(d["blk"] == lo)
    j = i if lo == hi else np.flatnonzero(d["blk"] == hi)
    score = collisions(d["sig"][i], d["sig"][j]).astype(np.int64)
    small, large = np.minimum.outer(d["n"][i], d["n"][j]), np.maximum.outer(d["n"][i], d["n"][j])
    ok = (score >= MATCHES) & (100 * small >= 75 * large)
    if lo == hi:
        np.fill_diagonal(ok, False)
    return i, j, score, ok


def forest_pairs(work: DataFrame) -> DataFrame:
    """Pairs of set keys: a maximum spanning forest of each piece's candidates."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (_, lo, hi), d in _pieces_of(batches, ["blk", "set_key", "n", "sig"]):
            i, j, score, ok = _candidates(lo, hi, d)
            if not ok.any():
                continue
            score[~ok] = 0
            if lo != hi:
                both = np.zeros((len(i) + len(j),) * 2, dtype=np.int64)
                both[:len(i), len(i):], both[len(i):, :len(i)] = score, score.T
                score, i = both, np.concatenate((i, j))
            edges = np.array(_forest(score), dtype=np.int64).reshape(-1, 2)
            a, b = d["set_key"][i[edges[:, 0]]], d["set_key"][i[edges[:, 1]]]
            yield pd.DataFrame({"a": np.where(a < b, a, b), "b": np.where(a < b, b, a)})

    return work.mapInPandas(frugal(run), "a binary, b binary").distinct()


def open_classes(work: DataFrame) -> DataFrame:
    """(token, lo, hi, set_key, comp) of the classes that have, in this piece, a
    candidate in another component with which they share no earlier token."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (token, lo, hi), d in _pieces_of(batches, ["blk", "set_key", "n", "sig", "early", "comp"]):
            if (d["comp"] == d["comp"][0]).all():
                continue
            i, j, _, ok = _candidates(lo, hi, d)
            ok &= d["comp"][i][:, None] != d["comp"][j][None, :]
            for c in range(COORDS) if ok.any() else ():
                posted = (d["early"] >> c & 1).astype(bool)
                if posted[i].any() and posted[j].any():
                    ok &= ~((posted[i][:, None] & posted[j][None, :]) & (d["sig"][i, c][:, None] == d["sig"][j, c][None, :]))
            if ok.any():
                rows = np.union1d(i[ok.any(1)], j[ok.any(0)])
                yield pd.DataFrame({"token": token, "lo": lo, "hi": hi, "set_key": d["set_key"][rows], "comp": d["comp"][rows]})

    return work.mapInPandas(frugal(run), "token long, lo int, hi int, set_key binary, comp binary")


def common_shingles(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of the sets."""
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    first = np.r_[True, values[1:] != values[:-1]]
    column = np.cumsum(first) - 1
    shared = np.bincount(column)[column] > 1
    column, owner = column[shared], owner[shared]
    column = np.cumsum(np.r_[True, column[1:] != column[:-1]]) - 1 if len(column) else column
    out = np.zeros((len(sets), len(sets)), dtype=np.int64)
    width = 2048
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [at, at + width])
        x = np.zeros((len(sets), width), dtype=np.float32)
        x[owner[a:b], column[a:b] - at] = 1
        out += (x @ x.T).astype(np.int64)
    return out


def links_between(opened: DataFrame, sets: DataFrame) -> DataFrame:
    """Spanning forests of the exact links among the opened classes of each piece."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, d in _pieces_of(batches, ["set_key", "comp", "shingles"]):
            full = [np.frombuffer(b, np.uint64) for b in d["shingles"]]
            n = np.array([len(x) for x in full])
            both = common_shingles(full)
            linked = (100 * both >= 75 * (n[:, None] + n[None, :] - both)) & (d["comp"][:, None] != d["comp"][None, :])
            edges = np.array(_forest(linked.astype(np.int64)), dtype=np.int64).reshape(-1, 2)
            if len(edges):
                yield pd.DataFrame({"a": d["set_key"][edges[:, 0]], "b": d["set_key"][edges[:, 1]]})

    rows = opened.join(sets, "set_key").repartition("token", "lo", "hi").sortWithinPartitions("token", "lo", "hi", "set_key")
    return rows.mapInPandas(frugal(run), "a binary, b binary").distinct()


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are linked, judged on the full sets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            good = []
            for x, y in zip(pdf["sa"], pdf["sb"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                at = np.searchsorted(x, y)
                both = int((x[np.minimum(at, len(x) - 1)] == y).sum())
                good.append(100 * both >= 75 * (len(x) + len(y) - both))
            yield pdf.loc[good, ["a", "b"]]

    sa = sets.select(F.col("set_key").alias("a"), F.col("shingles").alias("sa"))
    sb = sets.select(F.col("set_key").alias("b"), F.col("shingles").alias("sb"))
    return pairs.join(sa, "a").join(sb, "b").select("a", "b", "sa", "sb").mapInPandas(frugal(run), "a binary, b binary")


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Shingle sets of the wanted classes (doc_id of one row, set_key)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, want = pdf["text"].tolist(), pdf["set_key"].tolist()
            for a, b in pieces(texts, 2_000_000):
                sets = shingle_sets(texts[a:b])
                same = [(k, s) for k, s in zip(want[a:b], sets) if _set_key(s) == k]
                yield pd.DataFrame({"set_key": [k for k, _ in same], "shingles": [s.tobytes() for _, s in same]})

    w = bounded_broadcast(wanted.select(F.col("doc_id").alias("_id"), "set_key"), BROADCAST_ROWS)
    rows = docs.select(F.col("doc_id"), "text").join(w, F.col("doc_id").eqNullSafe(F.col("_id"))).select("text", "set_key")
    # an id that several rows have can give a set more than once
    return rows.mapInPandas(frugal(run), "set_key binary, shingles binary").dropDuplicates(["set_key"])


def components(edges: DataFrame, stages: Stages) -> DataFrame:
    """(v, comp): the smallest key that each vertex of the edges reaches, by
    alternating large-star and small-star steps over stored tables."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))   # (u, v)
        if large:
            m = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
            return both.filter("v > u").join(m, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = both.filter("v < u")
        m = down.groupBy("u").agg(F.min("v").alias("m"))
        links = down.join(m, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return links.unionAll(m.select("u", F.col("m").alias("v"))).distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("decimal(30,0)"))).first())

    e = stages.write(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "edges")
    before = state(e)
    while before[0]:
        e = stages.write(star(star(e, True), False), "stars")
        now = state(e)
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("set_key"), F.col("v").alias("comp"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    spark = docs.sparkSession
    with Stages(spark) as stages:
        sk = stages.write(sketch(docs), "sketch", keep=True)
        classes = (sk.filter("n_shingles > 0").groupBy("set_key")
                   .agg(F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.min("doc_id").alias("doc_id")))
        active = stages.write(active_classes(stages.write(classes, "classes")), "active")
        sets = stages.write(full_sets(docs, active.select("doc_id", "set_key")), "sets")

        few = F.slice("toks", 1, FOREST_TOKENS)
        links = stages.write(confirm(forest_pairs(work_pieces(active, few, [])), sets), "links")
        comp = components(links, stages)
        named = active.join(comp, "set_key", "left").withColumn("comp", F.coalesce("comp", "set_key"))
        opened = open_classes(work_pieces(named, F.col("toks"), ["comp"]))
        across = stages.write(links_between(opened, sets), "links")
        if not across.isEmpty():
            comp = components(comp.select(F.col("set_key").alias("a"), F.col("comp").alias("b")).unionAll(across), stages)

        members = classes.select("set_key", "doc_id").join(comp, "set_key", "left").withColumn("comp", F.coalesce("comp", "set_key"))
        names = members.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
        members = stages.write(members.select("set_key", "comp").join(names, "comp").select("set_key", "component_id"), "members", keep=True)
    out = sk.join(members, "set_key", "left").withColumn(
        "component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


#: The same rows by an all-pairs count of shared shingles.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
x AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.c = e.a)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, m.c AS component_id, s.doc_id = m.c AS kept
FROM s JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m USING (doc_id)
"""
