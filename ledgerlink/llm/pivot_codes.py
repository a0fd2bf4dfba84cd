"""Vector codes: product quantisation in whole numbers, pruned by fixed pivots.

Components become floor(SCALE * x), vectors are cut into ``PARTS`` equal parts,
and each part position has a codebook of ``ENTRIES`` entries. The codebook starts
with that part of the rows with the smallest ids; each of ``ROUNDS`` rounds gives
every part its nearest entry (squared Euclidean distance, ties to the lower
index) and puts floor(sum / count) of its parts in the place of each entry that
was used. Finally all parts are assigned again.

Nearest entries are found in the manner of LAESA. ``PIVOTS`` points a position,
taken from the first codebook far from each other, stay fixed. The distances of
each part to them are computed once and stored beside the parts. In a round only
the few distances of pivots to entries are new: by the triangle inequality
max_p |d(part, p) - d(entry, p)| bounds the distance of part and entry from
below, so entries are tried in the order of that bound and a part is done when
the bound exceeds the best distance so far. The distances that are evaluated are
exact sums of whole numbers, and the bound is lowered by more than the rounding
error of its square roots, so ties and results are those of a full search.

Each round is one pass over the stored parts. A task adds up its own parts by
position and entry, so PARTS x ENTRIES sums of it are shuffled and as many reach
the driver, however many rows there are and however they are spread over entries.

Defined cases: rows whose vector is null or empty or holds null or non-finite
components take no part, nor do those whose length is not that of the first row
(by id) with a length divisible by ``PARTS``. Rows that repeat an id are separate
rows; among equal ids the smaller vector comes first, rows without an id come
last. Fewer than ``ENTRIES`` rows give a smaller codebook. An empty table gives
an empty result. Rows too large for sums of 64 bits are compared with every entry
in Python's unbounded whole numbers; an error beyond 64 bits is null. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm.common import broadcast_below, frugal, stage, table

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
PIVOTS = 4
#: Sums go to Spark in digits of so many bits, which long sums of many tasks hold.
LIMB = 40
LABEL_BYTES = 64 << 20
SALTS = 32


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, v: components as doubles) of the rows that may take part."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("v"))
    return rows.filter(F.size("v") > 0).filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))


def narrow_limit(width: int) -> int:
    """Below it, squared distances of parts of that width fit into 64 bits."""
    return math.isqrt((1 << 61) // max(1, width))


def whole(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of a row: 64-bit integers, or Python's if one is too large."""
    with np.errstate(over="ignore"):
        scaled = np.floor(x * SCALE)                     # a power of two: exact, but for an overflow
    if (np.abs(scaled) < narrow_limit(len(x) // PARTS)).all():
        return scaled.astype(np.int64)
    return np.array([int(np.floor(v)) * SCALE + int(np.floor((v - np.floor(v)) * SCALE)) for v in x], dtype=object)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows."""
    d = x - y
    return (d * d).sum(axis=-1)


def root(x: np.ndarray) -> np.ndarray:
    return np.sqrt(x.astype(np.float64))


def far_apart(entries: np.ndarray, n: int) -> np.ndarray:
    """n of the entries: the first, then always the one farthest from those taken."""
    taken = entries[:1]
    while len(taken) < min(n, len(entries)):
        gap = np.min([squared(entries, p) for p in taken], axis=0)
        taken = np.concatenate((taken, entries[[int(np.argmax(gap))]]))
    return taken


class Position:
    """The codebook of one part position in one round, seen from its pivots."""

    def __init__(self, pivots: np.ndarray, entries: np.ndarray):
        self.entries = entries
        #: No bounds for numbers beyond 64 bits.
        self.to_pivots = None if entries.dtype == object or pivots.dtype == object else np.stack([root(squared(entries, p)) for p in pivots], axis=1)

    def nearest(self, x: np.ndarray, to_pivots: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, int]:
        """(index of the nearest entry, its squared distance) of each row, and how
        many distances were evaluated."""
        n, k = len(x), len(self.entries)
        if to_pivots is None or self.to_pivots is None:
            d = np.stack([squared(x.astype(object), e) for e in self.entries.astype(object)], axis=1)
            index = np.array([min(range(k), key=row.__getitem__) for row in d.tolist()], dtype=np.int64)
            return index, d[np.arange(n), index], n * k
        bound = np.zeros((n, k))
        for j in range(to_pivots.shape[1]):
            np.maximum(bound, np.abs(to_pivots[:, j, None] - self.to_pivots[None, :, j]), out=bound)
        bound -= 1e-12 * (to_pivots.max(axis=1) + self.to_pivots.max())[:, None]          # far above the rounding of the roots
        order = np.argsort(bound, axis=1, kind="stable")
        index = order[:, 0].copy()
        best = squared(x, self.entries[index])
        rows, evaluated = np.arange(n), n
        for j in range(1, k):
            entry = order[rows, j]
            near = bound[rows, entry] <= root(best[rows]) * (1 + 1e-12)
            rows, entry = rows[near], entry[near]        # the entries after it have no lower bound
            if not len(rows):
                break
            d = squared(x[rows], self.entries[entry])
            evaluated += len(rows)
            better = (d < best[rows]) | ((d == best[rows]) & (entry < index[rows]))
            best[rows[better]], index[rows[better]] = d[better], entry[better]
        return index, best, evaluated


class Codebooks:
    """All positions of one round."""

    def __init__(self, pivots: list[np.ndarray], entries: list[np.ndarray]):
        self.positions = [Position(p, e) for p, e in zip(pivots, entries)]

    def assign(self, pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(row numbers, parts x rows x width, indexes, squared distances) of the
        stored rows, those of 64 bits first."""
        width = self.positions[0].entries.shape[1]
        is_wide = pdf["wide"].notna().to_numpy()
        for wide in (False, True):
            at = np.flatnonzero(is_wide == wide)
            if not len(at):
                continue
            some = pdf.iloc[at]
            if wide:
                x = np.array([[int(v) for v in r.split(",")] for r in some["wide"]], dtype=object)
            else:
                x = np.frombuffer(b"".join(some["ints"]), dtype="<i4").astype(np.int64)
                far = np.frombuffer(b"".join(some["far"]), dtype="<f8").reshape(len(at), PARTS, -1)
            x = x.reshape(len(at), PARTS, width).transpose(1, 0, 2)
            found = [q.nearest(x[i], None if wide or not far.shape[2] else far[:, i]) for i, q in enumerate(self.positions)]
            yield at, x, np.stack([f[0] for f in found]), np.stack([f[1] for f in found])


def store_parts(rows: DataFrame, pivots: list[np.ndarray]) -> DataFrame:
    """Whole-number components of each row, and the distances of its parts to the pivots."""
    bounded = all(p.dtype != object for p in pivots)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            values = np.stack(pdf["v"].to_numpy())
            with np.errstate(over="ignore"):
                scaled = np.floor(values * SCALE)
            fits = (np.abs(scaled) < narrow_limit(scaled.shape[1] // PARTS)).all(axis=1)
            x = np.where(fits[:, None], scaled, 0).astype(np.int64)
            cut = x.reshape(len(x), PARTS, -1)
            far = np.stack([root(squared(cut[:, i], p)) for i in range(PARTS) for p in pivots[i]], axis=1) if bounded else np.zeros((len(x), 0))
            wide = [None if ok else ",".join(map(str, whole(v))) for ok, v in zip(fits, values)]
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "label": pdf["label"], "ints": [r.tobytes() for r in x.astype("<i4")],
                                "wide": pd.Series(wide, dtype=object), "far": [r.tobytes() for r in far.astype("<f8")]})

    text = rows.select(F.col("vec_id").cast("string").alias("vec_id"), F.col("label").cast("string").alias("label"), "v")
    return text.mapInPandas(frugal(run), "vec_id string, label string, ints binary, wide string, far binary")


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """(place, digit) of a whole number; digits have its sign."""
    sign, rest, place = (-1 if value < 0 else 1), abs(value), 0
    while rest or not place:
        yield place, sign * (rest & (1 << LIMB) - 1)
        rest, place = rest >> LIMB, place + 1


def means(parts: DataFrame, books: Codebooks, entries: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks of the next round."""
    width = entries[0].shape[1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((PARTS, len(entries[0]), width), dtype=object)
        counts = np.zeros((PARTS, len(entries[0])), dtype=np.int64)
        for pdf in batches:
            for _, x, index, _ in books.assign(pdf):
                for i in range(PARTS):
                    counts[i] += np.bincount(index[i], minlength=counts.shape[1])
                    for e in np.unique(index[i]):
                        sums[i, e] += x[i][index[i] == e].sum(axis=0).astype(object)
        out = [(i, e, c, place, digit, int(counts[i, e])) for i, e in np.argwhere(counts).tolist()
               for c in range(width) for place, digit in limbs(int(sums[i, e, c]))]
        yield pd.DataFrame(out, columns=["part", "entry", "c", "place", "digit", "n"])

    local = parts.mapInPandas(frugal(run), "part int, entry int, c int, place int, digit long, n long")
    rows = local.groupBy("part", "entry", "c", "place").agg(F.sum("digit").alias("digit"), F.sum("n").alias("n")).collect()
    total: dict[tuple, int] = {}
    count: dict[tuple, int] = {}
    for r in rows:                                       # dimensions x ENTRIES rows
        total[r.part, r.entry, r.c] = total.get((r.part, r.entry, r.c), 0) + (r.digit << LIMB * r.place if r.digit >= 0 else -(-r.digit << LIMB * r.place))
        if r.place == 0:
            count[r.part, r.entry] = r.n
    out = []
    for i, old in enumerate(entries):
        new = [[total[i, e, c] // count[i, e] for c in range(width)] if (i, e) in count else old[e].tolist() for e in range(len(old))]
        out.append(integers(new))
    return out


def integers(rows: list[list[int]]) -> np.ndarray:
    limit = narrow_limit(len(rows[0]))
    return np.array(rows, dtype=np.int64 if all(abs(v) < limit for r in rows for v in r) else object)


def compress(vectors: DataFrame, rounds: int = ROUNDS, **columns: str) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error of every usable row, as a stored table; the
    final codebooks by position)."""
    spark = vectors.sparkSession
    kinds = {f.name: f.dataType for f in usable(vectors, **columns).schema}
    rows = usable(vectors, **columns).filter(F.size("v") % PARTS == 0)
    order = [F.asc_nulls_last("vec_id"), F.asc("v")]
    lead = rows.orderBy(*order).limit(1).collect()
    if not lead:
        empty = spark.createDataFrame([], "code string, error long")
        return empty.select(F.lit(None).cast(kinds["vec_id"]).alias("vec_id"), F.lit(None).cast(kinds["label"]).alias("label"), "code", "error"), []
    rows = rows.filter(F.size("v") == len(lead[0].v))
    start = [whole(np.array(r.v)) for r in rows.orderBy(*order).limit(ENTRIES).select("v").collect()]
    entries = [integers([[int(v) for v in x.reshape(PARTS, -1)[i]] for x in start]) for i in range(PARTS)]
    pivots = [far_apart(e, PIVOTS) for e in entries]
    parts = stage(store_parts(rows, pivots), "vector-parts")
    for _ in range(rounds):
        entries = means(parts, Codebooks(pivots, entries), entries)
    books = Codebooks(pivots, entries)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            code, error = np.empty(len(pdf), dtype=object), np.empty(len(pdf), dtype=object)
            for at, _, index, far in books.assign(pdf):
                code[at] = ["".join(f"{e:02x}" for e in row) for row in index.T.tolist()]
                error[at] = [str(sum(map(int, row))) for row in far.T.tolist()]
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "label": pdf["label"], "code": code, "error": error})

    coded = parts.mapInPandas(frugal(run), "vec_id string, label string, code string, error string")
    coded = coded.select(F.col("vec_id").cast(kinds["vec_id"]).alias("vec_id"), F.col("label").cast(kinds["label"]).alias("label"), "code",
                         F.expr("try_cast(error AS bigint)").alias("error"))
    return stage(coded, "vector-codes"), entries


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``: the errors of all rows with the same label (nulls
    together), null if one of them or the sum is beyond 64 bits."""
    total = F.when(F.count("error") == F.count(F.lit(1)), F.expr("try_cast(sum(CAST(error AS DECIMAL(38, 0))) AS bigint)"))
    sums = coded.groupBy(F.col("label").alias("_label")).agg(total.alias("label_error"))
    size = F.lit(24) + F.coalesce(F.octet_length(F.col("_label").cast("string")), F.lit(0))
    hinted = broadcast_below(sums, size, LABEL_BYTES)
    if hinted is not sums:
        return coded.join(hinted, F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")
    # many labels: rows of one label are dealt over SALTS partitions
    salted = coded.withColumn("_salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    sums = sums.withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(sums, F.col("label").eqNullSafe(F.col("_label")) & (F.col("_salt") == F.col("_at")), "left").drop("_label", "_salt", "_at")


def codebooks_digest(entries: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(v) for book in entries for e in book.tolist() for v in e).encode()).hexdigest()


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, entries = compress(table(spark, sf_dir, "embeddings"))
    out = with_label_error(coded).withColumn("codebooks_sha256", F.lit(codebooks_digest(entries)))
    return out.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _oracle() -> str:
    def assigned(n: int) -> str:
        # distance and index in one number: the least distance, then the least index
        return f"""a{n} AS MATERIALIZED (
  SELECT vec_id, p, any_value(x) AS x, min(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * {ENTRIES} + e) AS k
  FROM parts JOIN c{n} USING (p) GROUP BY vec_id, p)"""

    def moved(n: int) -> str:
        return f"""s{n} AS (SELECT p, e, i, sum(v) AS s, count(*) AS n
  FROM (SELECT p, k % {ENTRIES} AS e, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM a{n - 1}) GROUP BY p, e, i),
m{n} AS (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{n} GROUP BY p, e),
c{n} AS MATERIALIZED (SELECT p, e, coalesce(m{n}.c, c{n - 1}.c) AS c FROM c{n - 1} LEFT JOIN m{n} USING (p, e))"""

    steps = [assigned(0)] + [x for n in range(1, ROUNDS + 1) for x in (moved(n), assigned(n))]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT vec_id, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS x FROM kept, range({PARTS}) t(p)),
lead AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < {ENTRIES}),
c0 AS MATERIALIZED (SELECT p, e, x AS c FROM parts JOIN lead USING (vec_id)),
{", ".join(steps)},
codes AS (SELECT vec_id, string_agg(printf('%02x', CAST(k % {ENTRIES} AS INTEGER)), '' ORDER BY p) AS code,
  CAST(sum(k // {ENTRIES}) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY vec_id),
book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM codes JOIN kept USING (vec_id) CROSS JOIN book
"""


ORACLE = _oracle()
