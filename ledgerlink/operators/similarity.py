"""Exact cosine top-N similarity join (J9), single and batched searches.

No form here materialises the query x catalogue pairs as rows.

blocked form     The default. Per group (optional
                 equality constraint), queries are hashed into ``bq`` blocks and
                 catalogue rows into ``bt`` blocks, with ``bq``/``bt`` derived
                 from the group's row counts so that all groups together make
                 about ``TASKS`` block pairs, each group as many as its share of
                 the pairs, and no block exceeds ``BLOCK_BYTES``. Each
                 query row is replicated to the ``bt`` catalogue blocks of its
                 group and each catalogue row to the ``bq`` query blocks; a
                 ``cogroup`` on (group, query block, catalogue block) computes a
                 partial top-N per query, and a final ``row_number`` per group
                 and query (with a partial ``WindowGroupLimit``) keeps the N best.

broadcast form   On request, for a small catalogue: its matrix is broadcast after
                 its size is checked against ``max_broadcast_bytes``, and every
                 query partition streams past it. Same rows as the blocked form.

pruned form      On request, without groups, for vectors that lie in clusters:
                 same rows again, but blocks of the catalogue that cannot hold
                 one of a query's N best are never sent the query (see
                 ``topk_pruned``).

In a task, ``SLICE`` queries at a time meet ``CHUNK`` catalogue rows, so the
working memory does not depend on the size of the blocks. A product in single
precision with its error bound finds the few rows that can still enter a query's
list; only those are scored and ranked in double precision. A null group matches
nothing. A query id that occurs in several groups gets its N best in each.
Vectors that are null, hold null or non-finite components, or are not of the
catalogue's most common length take no part.

Ranking: similarity rounded to 9 decimals, descending, then catalogue id
ascending (the reference has no tie-break; Q6). Zero-norm vectors score 0.
Ids are integers or natural text keys (e.g. the text itself, a catalogue code).
The last bits of a matrix product depend on its shape, so the scores that are
returned, and those that stand at a rounding border, are sums in a fixed order:
all forms and block sizes give the same bits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.functions import vectors as V
from ledgerlink.functions.cols import c, round_half_away
from ledgerlink.session import bounded_broadcast, materialize

RANK_DECIMALS = 9
SLICE, CHUNK, PAIRS = 512, 4096, 65_536
#: Catalogue rows that meet a slice first, to fill the lists.
FIRST = 512
OUT_SCHEMA = "q_id long, rank long, t_id long, similarity double"
# ids may be integers or text (natural keys); an empty slot sorts after any id
_TEXT_SENTINEL = "\U0010ffff" * 4


# ------------------------------------------------------------------ numpy kernel

def _row_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products along the last axis, added in the order of the components."""
    out = np.zeros(a.shape[:-1])
    for j in range(a.shape[-1]):
        out += a[..., j] * b[..., j]
    return out


def _unit_rows(m: np.ndarray) -> np.ndarray:
    n = np.sqrt(_row_products(m, m))
    n[n == 0] = np.inf            # zero vector -> all similarities 0
    return m / n[:, None]


def _stack(col: pd.Series, dim: int | None = None) -> np.ndarray:
    if len(col) == 0:
        return np.zeros((0, dim or 0))
    return np.vstack([np.asarray(v, dtype=np.float64) for v in col.to_numpy()])


def _rank_key(s: np.ndarray) -> np.ndarray:
    """Scores rounded half away from zero, as ``round_half_away`` does."""
    scale = 10.0 ** RANK_DECIMALS
    return np.sign(s) * np.floor(np.abs(s) * scale + 0.5) / scale


def _k_best(s: np.ndarray, k: int) -> np.ndarray:
    """Columns (n x k) of the k best of each row; of equal ones the first."""
    m = s.shape[1]
    if m <= k:
        return np.broadcast_to(np.arange(m), s.shape)
    key = _rank_key(s)
    limit = np.partition(key, m - k, axis=1)[:, m - k, None]
    above, equal = key > limit, key == limit
    need = k - above.sum(axis=1, keepdims=True)
    keep = above | (equal & (np.cumsum(equal, axis=1, dtype=np.int32) <= need))
    return np.nonzero(keep)[1].reshape(len(s), k)


def _settle(s: np.ndarray, qu: np.ndarray, tu: np.ndarray, k: int) -> None:
    """Put the sum in fixed order in the place of each score that may be among a
    row's k best and lies so near a rounding border that its rank depends on it."""
    m = s.shape[1]
    limit = np.partition(s, m - k, axis=1)[:, m - k, None] if m > k else np.full((len(s), 1), -np.inf)
    rows, cols = np.nonzero((s >= limit - 2 * 10.0 ** -RANK_DECIMALS) & (s > -np.inf))
    scaled = np.abs(s[rows, cols]) * 10.0 ** RANK_DECIMALS
    near = np.abs(scaled - np.floor(scaled) - 0.5) < 1e-5
    rows, cols = rows[near], cols[near]
    for a in range(0, len(rows), PAIRS):
        r, t = rows[a:a + PAIRS], cols[a:a + PAIRS]
        s[r, t] = _row_products(qu[r], tu[t])


def _merge_topk(best_s, best_p, s, first, k):
    """Merge a (n x m) score block of the catalogue rows from ``first`` on into the
    running (n x k) best lists. Order: rounded score desc, then position (ids
    ascend with it). ``best_s`` holds -inf for empty slots."""
    cols = _k_best(s, k)
    all_s = np.concatenate([best_s, np.take_along_axis(s, cols, axis=1)], axis=1)
    all_p = np.concatenate([best_p, first + cols], axis=1)
    key = _rank_key(all_s)
    # lexsort: last key is primary -> sort by (-key, position)
    order = np.lexsort((all_p, -key), axis=1)[:, :k]
    return np.take_along_axis(all_s, order, axis=1), np.take_along_axis(all_p, order, axis=1)


def _id_array(col: pd.Series) -> np.ndarray:
    if pd.api.types.is_integer_dtype(col.dtype):
        return col.to_numpy(dtype=np.int64)
    return col.astype(object).to_numpy()


def topk_block(q_ids, q_mat, q_grp, t_ids, t_mat, t_grp, k, exclude_self, chunk=CHUNK, unit=False, least=None):
    """Top-k of every query row against a catalogue block (numpy), ``SLICE``
    queries at a time; ``unit`` says that all vectors have length 1 (or 0). With
    ``least`` (a score for each query) rows that rank below it may be left out."""
    order = np.argsort(t_ids, kind="stable")
    t_ids, tu, t_grp = t_ids[order], t_mat[order], t_grp[order] if t_grp is not None else None
    if not unit:
        q_mat, tu = _unit_rows(q_mat), _unit_rows(tu)
    t32 = tu.astype(np.float32)
    parts = [_topk_slice(q_ids[a:a + SLICE], q_mat[a:a + SLICE], q_grp[a:a + SLICE] if q_grp is not None else None,
                         t_ids, tu, t32, t_grp, k, exclude_self, chunk, least[a:a + SLICE] if least is not None else None)
             for a in range(0, max(1, len(q_ids)), SLICE)]
    return np.concatenate([s for s, _ in parts]), np.concatenate([i for _, i in parts])


def _topk_slice(q_ids, qu, q_grp, t_ids, tu, t32, t_grp, k, exclude_self, chunk, least):
    n, step = len(q_ids), 10.0 ** -RANK_DECIMALS
    best_s, best_p = np.full((n, k), -np.inf), np.zeros((n, k), dtype=np.int64)
    if n == 0 or len(t_ids) == 0:
        return best_s, _named(best_s, best_p, t_ids)
    # a row enters a list only with a rank above ``bar``: behind the list's last row
    # no equal one counts, as ids ascend; a score that was given may be equalled
    floor = _rank_key(least) - step if least is not None else np.full(n, -np.inf)
    # twice what unit vectors' products in single precision are off by, and a rank's rounding
    slack = (tu.shape[1] + 8) * 2.0 ** -23 + 2 * step
    q32, few = qu.astype(np.float32), 8 * k + 64

    def allowed(rows, cols, a):
        ok = np.ones(len(rows), dtype=bool)
        if q_grp is not None:
            ok &= q_grp[rows] == t_grp[a + cols]
        if exclude_self:
            ok &= q_ids[rows] != t_ids[a + cols]
        return ok

    a, width = 0, min(chunk, max(FIRST, 8 * k))
    while a < len(t_ids):
        b = min(a + width, len(t_ids))
        bar = np.maximum(floor, _rank_key(best_s[:, k - 1]))
        crowded = ~np.isfinite(bar)
        if not crowded.all():
            rows, cols = np.divmod(np.flatnonzero(q32 @ t32[a:b].T >= (bar - slack).astype(np.float32)[:, None]), b - a)
            many = np.bincount(rows, minlength=n) > few
            crowded |= many
            some = ~crowded[rows]
            rows, cols = rows[some], cols[some]
            some = allowed(rows, cols, a)
            _enter(best_s, best_p, rows[some], cols[some], a, qu, tu, bar, k)
        if crowded.any():
            # rows with many candidates: all scores in double precision
            r = np.flatnonzero(crowded)
            s = qu[r] @ tu[a:b].T
            if q_grp is not None:
                s[q_grp[r][:, None] != t_grp[a:b][None, :]] = -np.inf
            if exclude_self:
                s[q_ids[r][:, None] == t_ids[a:b][None, :]] = -np.inf
            can = np.isinf(bar[r]) | (s >= (bar[r] + step / 2 - 1e-12)[:, None]).any(axis=1)
            r, s = r[can], s[can]
            if len(r):
                _settle(s, qu[r], tu[a:b], k)
                s[_rank_key(s) <= floor[r][:, None]] = -np.inf
                best_s[r], best_p[r] = _merge_topk(best_s[r], best_p[r], s, a, k)
        a, width = b, min(2 * width, chunk)
    return _final_scores(best_s, best_p, qu, tu), _named(best_s, best_p, t_ids)


def _enter(best_s, best_p, rows, cols, first, qu, tu, bar, k):
    """Put single pairs (rows ascending), scored in fixed order, in the running lists."""
    for a in range(0, len(rows), PAIRS):
        r, p = rows[a:a + PAIRS], first + cols[a:a + PAIRS]
        s = _row_products(qu[r], tu[p])
        above = _rank_key(s) > bar[r]
        r, p, s = r[above], p[above], s[above]
        if not len(r):
            continue
        own = np.unique(r)
        all_r = np.concatenate([np.repeat(own, k), r])
        all_s = np.concatenate([best_s[own].ravel(), s])
        all_p = np.concatenate([best_p[own].ravel(), p])
        order = np.lexsort((all_p, -_rank_key(all_s), all_r))
        # every list has its k old entries here, so the k best are there
        kept = order[np.searchsorted(all_r[order], own)[:, None] + np.arange(k)]
        best_s[own], best_p[own] = all_s[kept], all_p[kept]


def _final_scores(best_s, best_p, qu, tu):
    """The scores of the kept rows, added in fixed order."""
    exact = np.stack([_row_products(qu, tu[best_p[:, j]]) for j in range(best_p.shape[1])], axis=1)
    return np.where(np.isfinite(best_s), exact, -np.inf)


def _named(best_s, best_p, t_ids):
    """Catalogue ids of the kept rows; an id after all others in empty slots."""
    if t_ids.dtype == object:
        empty = np.full(best_s.shape, _TEXT_SENTINEL, dtype=object)
    else:
        empty = np.full(best_s.shape, np.iinfo(np.int64).max, dtype=np.int64)
    return np.where(np.isfinite(best_s), t_ids[best_p], empty) if len(t_ids) else empty


def _emit(q_ids, best_s, best_i) -> pd.DataFrame:
    ok = np.isfinite(best_s)
    rows, ranks = np.nonzero(ok)
    return pd.DataFrame({"q_id": q_ids[rows], "rank": (ranks + 1).astype(np.int64),
                         "t_id": best_i[rows, ranks], "similarity": best_s[rows, ranks]})


# ------------------------------------------------------------------ Spark forms

def _id_type(df: DataFrame, id_col: str) -> str:
    """``long`` for integer ids, ``string`` for any other natural key."""
    t = df.schema[id_col].dataType
    return "long" if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) else "string"


def _out_schema(q_type: str, t_type: str) -> str:
    return f"q_id {q_type}, rank long, t_id {t_type}, similarity double"


def _prep(df: DataFrame, id_col: str, vec_col: str, grp: str | None, dim: int) -> DataFrame:
    cols = [c(id_col).cast(_id_type(df, id_col)).alias("_id"), V.as_double_vector(vec_col).alias("_v")]
    cols.append((c(grp).cast("string") if grp else F.lit("")).alias("_g"))
    finite = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.select(*cols).where(F.col("_g").isNotNull() & (F.size("_v") == dim) & finite)


def vector_dim(df: DataFrame, vec_col: str) -> int:
    """The most common length of the vectors, the greater one of equals; 0 without
    any."""
    r = df.select(F.size(c(vec_col)).alias("d")).where(F.col("d") > 0).groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    return int(r["d"]) if r else 0


BLOCK_BYTES = 64 * 1024 * 1024      # one block's matrix in a task
#: Block pairs to make of all groups, rows below which a block is not split for
#: that, and blocks a side that a smaller ``block_rows`` is granted.
TASKS, LEAST_ROWS, MOST_SIDES = 64, 1024, 16
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def collect_catalogue(catalogue: DataFrame, t_id: str, t_vec: str, t_group: str | None,
                      max_bytes: int):
    """The catalogue as numpy arrays if its matrix fits ``max_bytes``, else None.
    Collects at most ``max_bytes / (8 x dim) + 1`` rows (never the whole table)."""
    dim = vector_dim(catalogue, t_vec)
    bound = max_bytes // (8 * max(dim, 1))
    cat = _prep(catalogue, t_id, t_vec, t_group, dim).limit(bound + 1).toPandas()
    if len(cat) > bound:
        return None
    return (_id_array(cat["_id"]), _stack(cat["_v"], dim), cat["_g"].to_numpy())


def topk_broadcast(queries: DataFrame, catalogue: DataFrame, k: int, q_id: str, q_vec: str,
                   t_id: str, t_vec: str, q_group: str | None = None, t_group: str | None = None,
                   exclude_self: bool = False, collected=None) -> DataFrame:
    """Broadcast form; ``collected`` is the checked catalogue (see
    ``collect_catalogue``)."""
    spark = queries.sparkSession
    if collected is None:
        collected = collect_catalogue(catalogue, t_id, t_vec, t_group, MAX_BROADCAST_BYTES)
    if collected is None:
        raise ValueError("catalogue exceeds the broadcast budget")
    t_ids, t_mat, t_grp_all = collected
    t_grp = t_grp_all if q_group else None
    bc = spark.sparkContext.broadcast((t_ids, t_mat, t_grp))
    use_group = q_group is not None

    def run(batches):
        ti, tm, tg = bc.value
        for pdf in batches:
            qi = _id_array(pdf["_id"])
            qm = _stack(pdf["_v"], tm.shape[1] if tm.ndim == 2 else None)
            qg = pdf["_g"].to_numpy() if use_group else None
            bs, bi = topk_block(qi, qm, qg, ti, tm, tg, k, exclude_self)
            yield _emit(qi, bs, bi)

    schema = _out_schema(_id_type(queries, q_id), _id_type(catalogue, t_id))
    return _prep(queries, q_id, q_vec, q_group, t_mat.shape[1]).mapInPandas(run, schema)


def topk_blocked(queries: DataFrame, catalogue: DataFrame, k: int, q_id: str, q_vec: str,
                 t_id: str, t_vec: str, q_group: str | None = None, t_group: str | None = None,
                 exclude_self: bool = False, block_rows: int | None = None) -> DataFrame:
    """Block x block form (no broadcast of the catalogue).

    A block holds at most ``BLOCK_BYTES / (8 x dim)`` rows, which keeps one block
    pair in task memory. A query row is replicated once per catalogue block of
    its group, so blocks are split further only until there are ``TASKS`` pairs
    of them, on both sides such that the fewest rows are replicated. With
    ``block_rows`` they are at most that small, up to ``MOST_SIDES`` blocks a side:
    beyond that they grow with the table, or replication would grow with its square.
    """
    dim = vector_dim(catalogue, t_vec)
    most_rows = max(256, BLOCK_BYTES // (8 * max(dim, 1)))
    q = _prep(queries, q_id, q_vec, q_group, dim)
    t = _prep(catalogue, t_id, t_vec, t_group, dim)
    schema = _out_schema(_id_type(queries, q_id), _id_type(catalogue, t_id))
    # per-group block counts: one row per group, from a partial aggregation
    qn = q.groupBy("_g").agg(F.count(F.lit(1)).alias("_nq"))
    tn = t.groupBy("_g").agg(F.count(F.lit(1)).alias("_nt"))
    counts = materialize(qn.join(tn, "_g"), "similarity-groups")
    pairs = counts.agg(F.sum(F.col("_nq") * F.col("_nt").cast("double"))).first()[0]
    want = F.greatest(F.lit(1.0), TASKS * (F.col("_nq") * F.col("_nt").cast("double")) / F.lit(pairs or 1.0))
    bt = F.least(want, F.greatest(F.lit(1.0), F.sqrt(want * F.col("_nt") / F.col("_nq"))))

    def nblk(n: str, wanted: Column) -> Column:
        parts = lambda rows: F.ceil(F.col(n) / rows)
        asked = F.least(parts(block_rows), F.lit(MOST_SIDES)) if block_rows else F.lit(1)
        return F.greatest(F.lit(1), F.least(F.ceil(wanted), parts(LEAST_ROWS)), asked, parts(most_rows)).cast("int")

    blocks = counts.select("_g", nblk("_nq", want / bt).alias("_bq"), nblk("_nt", bt).alias("_bt"))
    if q_group is None:
        # one group: two numbers, applied as literals (no join at all)
        row = blocks.first()
        if row is None:
            return queries.sparkSession.createDataFrame([], schema)
        qj = q.withColumn("_bq", F.lit(row["_bq"])).withColumn("_bt", F.lit(row["_bt"]))
        tj = t.withColumn("_bq", F.lit(row["_bq"])).withColumn("_bt", F.lit(row["_bt"]))
    else:
        small = bounded_broadcast(blocks, 1_000_000)      # one row per group
        qj, tj = q.join(small, "_g"), t.join(small, "_g")
    qb = (qj.withColumn("_qb", F.pmod(F.xxhash64("_id"), F.col("_bq")).cast("int"))
          .withColumn("_tb", F.explode(F.sequence(F.lit(0), F.col("_bt") - 1)))
          .select("_g", "_qb", "_tb", "_id", "_v"))
    tb = (tj.withColumn("_tb", F.pmod(F.xxhash64("_id"), F.col("_bt")).cast("int"))
          .withColumn("_qb", F.explode(F.sequence(F.lit(0), F.col("_bq") - 1)))
          .select("_g", "_qb", "_tb", "_id", "_v"))

    def run(_key, qp: pd.DataFrame, tp: pd.DataFrame) -> pd.DataFrame:
        qi = _id_array(qp["_id"])
        ti = _id_array(tp["_id"])
        if len(qi) == 0 or len(ti) == 0:
            out = pd.DataFrame({"q_id": qi[:0], "rank": np.zeros(0, np.int64), "t_id": ti[:0],
                                "similarity": np.zeros(0)})
        else:
            bs, bi = topk_block(qi, _stack(qp["_v"]), None, ti, _stack(tp["_v"]), None, k, exclude_self)
            out = _emit(qi, bs, bi)
        return out.assign(_g=_key[0])

    partial = (qb.groupBy("_g", "_qb", "_tb")
               .cogroup(tb.groupBy("_g", "_qb", "_tb"))
               .applyInPandas(run, schema + ", _g string"))
    return _best(partial, k, "_g").drop("_g")


def _best(partial: DataFrame, k: int, *keys: str) -> DataFrame:
    """The k best of each query's partial lists."""
    w = Window.partitionBy(*keys, "q_id").orderBy(
        F.desc(round_half_away(F.col("similarity"), RANK_DECIMALS)), F.asc("t_id"))
    return partial.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


# ------------------------------------------------------------------ pruned form

PIVOTS, PIVOT_SAMPLE, BANDS = 64, 512, 16
#: Above the rounding of angles and of ranks.
MARGIN = 1e-7
#: Blocks of the catalogue, as a query that is sent to all is repeated as often,
#: and parts of a block that all queries ask for.
MOST_BLOCKS, MOST_PARTS = 32, 8


class AngleCells:
    """Cells of the catalogue: nearest pivot and band of the angle to it, with the
    smallest and largest angle and the number of rows of each cell that is not
    empty, and the blocks they are dealt to. At most PIVOTS x BANDS + 1 cells."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots

    def angles(self, unit: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(unit @ self.pivots.T, -1.0, 1.0))

    def place(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, angle to its pivot) of each row; vectors of length zero have a
        cell of their own."""
        a = self.angles(unit)
        p = a.argmin(axis=1)
        angle = a[np.arange(len(a)), p]
        band = np.minimum((angle / np.pi * BANDS).astype(np.int64), BANDS - 1)
        return np.where(unit.any(axis=1), p * BANDS + band, len(self.pivots) * BANDS), angle

    def deal(self, cells: np.ndarray, low: np.ndarray, high: np.ndarray, rows: np.ndarray, block_rows: int) -> None:
        """Neighbouring cells share a block of about ``block_rows`` rows, a larger
        cell is split over several."""
        self.cells, self.low, self.high, self.rows = cells, low, high, rows
        self.first, self.splits, self.n_blocks, held = np.zeros(len(cells), np.int64), np.ones(len(cells), np.int64), 0, 0
        for i, n in enumerate(rows.tolist()):
            if not self.n_blocks or held + n > block_rows:
                held = 0
                self.first[i] = self.n_blocks
                self.splits[i] = max(1, -(-n // block_rows))
                self.n_blocks += int(self.splits[i])
                held = n if self.splits[i] == 1 else block_rows
            else:
                self.first[i], held = self.n_blocks - 1, held + n

    def reach(self, unit: np.ndarray) -> np.ndarray:
        """(queries x cells) the most that a cosine with a row of the cell can be."""
        p = np.minimum(self.cells // BANDS, len(self.pivots) - 1)
        a = self.angles(unit)[:, p]
        out = np.cos(np.clip(np.maximum(self.low - a, a - self.high), 0.0, np.pi))
        out[:, self.cells == len(self.pivots) * BANDS] = 0.0
        out[~unit.any(axis=1)] = 0.0
        return out


def _spread(rows: np.ndarray, n: int) -> np.ndarray:
    """n of the rows, each the one with the largest angle to those before."""
    taken, best = [0], rows @ rows[0]
    while len(taken) < min(n, len(rows)):
        taken.append(int(best.argmin()))
        best = np.maximum(best, rows @ rows[taken[-1]])
    return rows[taken]


def _unit_column(pdf: pd.DataFrame, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(pdf["_u"]), dtype=np.float64).reshape(-1, dim)


def _meet(asked: DataFrame, indexed: DataFrame, part_rows: int, run, schema: str) -> DataFrame:
    """Cogroup of queries and catalogue rows of each block. A block that many
    queries ask for is repeated for every ``part_rows`` of them."""
    n = asked.groupBy("_b").agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("_n"))
    n = bounded_broadcast(materialize(n, "similarity-parts"), 1_000_000)      # one row per block
    q = asked.join(n, "_b").withColumn("_s", F.pmod(F.xxhash64("_id"), F.col("_n")).cast("int")).drop("_n")
    t = indexed.join(n, "_b").withColumn("_s", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).drop("_n")
    return q.groupBy("_b", "_s").cogroup(t.groupBy("_b", "_s")).applyInPandas(run, schema)


def _pruned_parts(queries: DataFrame, catalogue: DataFrame, k: int, q_id: str, q_vec: str, t_id: str, t_vec: str,
                  exclude_self: bool, block_rows: int | None):
    """(cells, dimension, queries that share a part, catalogue rows by block, (query,
    block) pairs that can matter), or None without a usable row. Catalogue and
    queries are stored once; the pairs are derived where they are shuffled."""
    dim = vector_dim(catalogue, t_vec)
    most_rows = max(256, BLOCK_BYTES // (8 * max(dim, 1)))
    q, t = _prep(queries, q_id, q_vec, None, dim).drop("_g"), _prep(catalogue, t_id, t_vec, None, dim).drop("_g")
    sample = t.orderBy(F.xxhash64("_id"), "_id").limit(PIVOT_SAMPLE).select("_v").toPandas()["_v"]
    units = _unit_rows(_stack(sample, dim))
    units = units[units.any(axis=1)] if len(units) else units
    if not len(sample):
        return None
    cells = AngleCells(_spread(units, PIVOTS) if len(units) else np.zeros((1, dim)))
    q_type, t_type = _id_type(queries, q_id), _id_type(catalogue, t_id)

    def index(batches):
        for pdf in batches:
            u = _unit_rows(_stack(pdf["_v"], dim))
            cell, angle = cells.place(u)
            yield pd.DataFrame({"_id": pdf["_id"], "_u": [r.tobytes() for r in u], "_cell": cell, "_angle": angle})

    schema = "_id {}, _u binary, _cell int, _angle double"
    rows = materialize(t.mapInPandas(index, schema.format(t_type)), "similarity-index")
    stats = rows.groupBy("_cell").agg(F.min("_angle").alias("low"), F.max("_angle").alias("high"), F.count(F.lit(1)).alias("n")).orderBy("_cell").toPandas()
    block_rows = min(most_rows, max(block_rows or LEAST_ROWS, -(-int(stats["n"].sum()) // MOST_BLOCKS)))
    cells.deal(stats["_cell"].to_numpy(), stats["low"].to_numpy(), stats["high"].to_numpy(), stats["n"].to_numpy(), block_rows)
    where = {int(x): (int(a), int(n)) for x, a, n in zip(cells.cells, cells.first, cells.splits)}

    def block(batches):
        for pdf in batches:
            at = np.array([where[x] for x in pdf["_cell"].tolist()], dtype=np.int64).reshape(-1, 2)
            pdf["_b"] = (at[:, 0] + pdf["_h"].to_numpy() % at[:, 1]).astype(np.int32)
            yield pdf[["_b", "_id", "_u", "_cell"]]

    spread = F.pmod(F.xxhash64("_id"), F.lit(1 << 30)).alias("_h")
    indexed = rows.select("_id", "_u", "_cell", spread).mapInPandas(block, f"_b int, _id {t_type}, _u binary, _cell int")

    def home(batches):
        for pdf in batches:
            u = _unit_rows(_stack(pdf["_v"], dim))
            best = cells.reach(u).argmax(axis=1) if len(u) else np.zeros(0, np.int64)
            b = cells.first[best] + pdf["_h"].to_numpy() % cells.splits[best]
            yield pd.DataFrame({"_b": b.astype(np.int32), "_id": pdf["_id"], "_u": [r.tobytes() for r in u]})

    ask = materialize(q.select("_id", "_v", spread).mapInPandas(home, f"_b int, _id {q_type}, _u binary"), "similarity-queries")
    part_rows = min(most_rows, max(block_rows, -(-ask.count() // MOST_PARTS)))

    def pilot(_key, qp: pd.DataFrame, tp: pd.DataFrame) -> pd.DataFrame:
        if len(qp) and len(tp):
            s, _ = topk_block(_id_array(qp["_id"]), _unit_column(qp, dim), None, _id_array(tp["_id"]), _unit_column(tp, dim), None, k, exclude_self, unit=True)
            qp["_least"] = s[:, k - 1]
        else:
            qp["_least"] = -np.inf
        return qp[["_b", "_id", "_u", "_least"]]

    # every query's n-th best score in its nearest block: at least that much is needed elsewhere
    known = materialize(_meet(ask, indexed, part_rows, pilot, f"_b int, _id {q_type}, _u binary, _least double"), "similarity-known")

    def route(batches):
        for pdf in batches:
            for a in range(0, len(pdf), SLICE):
                some = pdf.iloc[a:a + SLICE]
                can = cells.reach(_unit_column(some, dim)) >= some["_least"].to_numpy()[:, None] - MARGIN
                flags = np.zeros((len(some), cells.n_blocks + 1), dtype=np.int32)
                # + 1 where a cell's run of blocks begins, - 1 behind it
                for i in range(len(cells.cells)):
                    flags[can[:, i], cells.first[i]] += 1
                    flags[can[:, i], cells.first[i] + cells.splits[i]] -= 1
                rows_, blocks = np.nonzero(np.cumsum(flags, axis=1)[:, :-1] > 0)
                yield pd.DataFrame({"_b": blocks.astype(np.int32), "_id": some["_id"].to_numpy()[rows_], "_u": some["_u"].to_numpy()[rows_],
                                    "_least": some["_least"].to_numpy()[rows_]})

    return cells, dim, part_rows, indexed, known.mapInPandas(route, f"_b int, _id {q_type}, _u binary, _least double")


def topk_pruned(queries: DataFrame, catalogue: DataFrame, k: int, q_id: str, q_vec: str, t_id: str, t_vec: str,
                exclude_self: bool = False, block_rows: int | None = None) -> DataFrame:
    """Pruned form: the rows of ``topk_blocked``, for vectors that lie in clusters.

    Up to ``PIVOTS`` rows of a bounded sample, far from each other, are pivots. A
    catalogue row's cell is its nearest pivot and the band of its angle to it.
    The angle between a query and a row of a cell is at least the difference of
    their angles to the pivot, so a cell has a highest cosine for each query. A
    pilot pass searches the one block where that is highest; the n-th best score
    found there is a lower bound, and the query is sent only to blocks that can
    reach it. Where vectors have no clusters every block stays in reach and the
    blocked form is the cheaper one."""
    schema = _out_schema(_id_type(queries, q_id), _id_type(catalogue, t_id))
    parts = _pruned_parts(queries, catalogue, k, q_id, q_vec, t_id, t_vec, exclude_self, block_rows)
    if parts is None:
        return queries.sparkSession.createDataFrame([], schema)
    _, dim, part_rows, indexed, routed = parts

    def run(_key, qp: pd.DataFrame, tp: pd.DataFrame) -> pd.DataFrame:
        qi, ti = _id_array(qp["_id"]), _id_array(tp["_id"])
        if not len(qi) or not len(ti):
            return pd.DataFrame({"q_id": qi[:0], "rank": np.zeros(0, np.int64), "t_id": ti[:0], "similarity": np.zeros(0)})
        s, i = topk_block(qi, _unit_column(qp, dim), None, ti, _unit_column(tp, dim), None, k, exclude_self, unit=True, least=qp["_least"].to_numpy())
        return _emit(qi, s, i)

    return _best(_meet(routed, indexed, part_rows, run, schema), k)


def pruned_pairs(queries: DataFrame, catalogue: DataFrame, k: int, q_id: str, q_vec: str, t_id: str, t_vec: str,
                 exclude_self: bool = False, block_rows: int | None = None) -> tuple[int, int]:
    """(pairs of queries and catalogue rows that the pruned form visits, all pairs)."""
    parts = _pruned_parts(queries, catalogue, k, q_id, q_vec, t_id, t_vec, exclude_self, block_rows)
    if parts is None:
        return 0, 0
    _, _, _, indexed, routed = parts
    rows = indexed.groupBy("_b").agg(F.count(F.lit(1)).alias("n"))
    visited = routed.groupBy("_b").agg(F.count(F.lit(1)).alias("q")).join(rows, "_b").agg(F.sum(F.col("q") * F.col("n"))).first()[0]
    return visited or 0, routed.select("_id").distinct().count() * (rows.agg(F.sum("n")).first()[0] or 0)


def topk_cosine(queries: DataFrame, catalogue: DataFrame, k: int, q_id: str, q_vec: str,
                t_id: str, t_vec: str, q_group: str | None = None, t_group: str | None = None,
                exclude_self: bool = False, mode: str = "blocked",
                max_broadcast_bytes: int = MAX_BROADCAST_BYTES, block_rows: int | None = None) -> DataFrame:
    """The ``k`` most similar catalogue rows of every query row.

    Returns ``(q_id, rank, t_id, similarity)``. ``mode`` is ``blocked`` (also
    under its old name ``auto``) or, on request, ``broadcast``, which raises for a
    catalogue matrix above ``max_broadcast_bytes``, or ``pruned``, which takes no
    groups. All give the same rows.
    """
    if mode == "pruned":
        if q_group or t_group:
            raise ValueError("the pruned form takes no groups")
        return topk_pruned(queries, catalogue, k, q_id, q_vec, t_id, t_vec, exclude_self, block_rows)
    args = (queries, catalogue, k, q_id, q_vec, t_id, t_vec, q_group, t_group, exclude_self)
    if mode == "broadcast":
        collected = collect_catalogue(catalogue, t_id, t_vec, t_group, max_broadcast_bytes)
        if collected is None:
            raise ValueError("catalogue exceeds the broadcast budget")
        return topk_broadcast(*args, collected=collected)
    return topk_blocked(*args, block_rows=block_rows)


# ------------------------------------------------------------ single query

def knn_search(catalogue: DataFrame, query: list[float], n: int, t_id: str, t_vec: str) -> DataFrame:
    """The ``n`` catalogue rows most similar to one query vector.

    The vector is a literal (its size is the dimension), scored by JVM
    higher-order functions; ``orderBy().limit()`` plans a distributed top-k."""
    q = F.array(*[F.lit(float(x)) for x in query])
    sim = V.cosine(V.as_double_vector(t_vec), q)
    return (catalogue.select(c(t_id).alias("t_id"), sim.alias("similarity"))
            .orderBy(F.desc(round_half_away(F.col("similarity"), RANK_DECIMALS)), F.asc("t_id")).limit(n))


def mean_vector(df: DataFrame, vec_col: str) -> list[float]:
    """Element-wise mean of all vectors: one bounded (dimension-sized) row."""
    row = V.mean_vectors(df, vec_col, []).first()
    return list(row[vec_col]) if row else []


def cosine_to_group_mean(df: DataFrame, id_col: str, vec_col: str, group_col: str) -> DataFrame:
    """F16 over whole tables: cosine of each vector with its group's mean vector.
    The means are one row per group, joined by key (broadcast when small)."""
    means = V.mean_vectors(df, vec_col, [group_col]).withColumnRenamed(vec_col, "_mean").drop("n")
    j = df.select(c(id_col), c(group_col), V.as_double_vector(vec_col).alias("_v")).join(means, group_col)
    return j.select(c(id_col), c(group_col), V.cosine(F.col("_v"), F.col("_mean")).alias("similarity"))
