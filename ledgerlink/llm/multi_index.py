"""Approximate nearest neighbours by an inverted multi-index.

Each vector's two halves are quantised separately with ``CENTROIDS`` centroids,
so a vector's cell is a pair of centroids. A query visits cells from the best
sum of its two half scores downwards, taking pairs from a heap, until the cells
seen hold the share ``VISIT`` of all distinct vectors (and ``LEAST`` of them).
All vectors in these cells are reranked by the exact inner product.

The codebooks are fitted on at most ``SAMPLE`` vectors (in the order of a hash of
the id); every row is indexed. Cells are grouped by their first centroid into
parts of about ``PART_ROWS`` rows, larger groups are dealt over several parts, and
a query goes only to the parts that hold a cell it visits. A task holds one part
and streams the queries past it, so neither a hot cell nor the number of queries
fills a task. No pair leaves a task but a query's best ``k`` of the part.

Defined cases: null, zero or non-finite vectors and null ids take no part, nor
do vectors whose length is not that of the sample's most common one; of rows
with the same id the one with the smallest vector counts. Fewer than ``k``
candidates give fewer rows. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlink.llm.common import Stages, table

CENTROIDS = 64
SAMPLE = 20_000
VISIT = 0.6
LEAST = 2_000
PART_ROWS = 40_000
QUERIES_AT_ONCE = 64


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the rows that take part."""
    e = F.col("embedding")
    ok = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(e, lambda x: x != 0)
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.filter(F.col("vec_id").isNotNull() & e.isNotNull()).filter(ok).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def fit_codebook(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """k-means centroids of the rows of x."""
    rng = np.random.RandomState(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        a = nearest(x, c)
        n = np.bincount(a, minlength=len(c))
        sums = np.stack([np.bincount(a, weights=x[:, j], minlength=len(c)) for j in range(x.shape[1])], axis=1)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c ** 2).sum(1) - 2.0 * (x @ c.T), axis=1)


def visited_cells(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, want: float) -> np.ndarray:
    """Flags of the cells (first x second) taken by descending sum of the two
    scores until they hold ``want`` vectors."""
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    fa, sb = first[a].tolist(), second[b].tolist()
    row, col = a.tolist(), b.tolist()
    n2 = len(second)
    flags = np.zeros(len(first) * n2, dtype=bool)
    held, heap, reach = 0, [(-(fa[0] + sb[0]), 0, 0)], [0] * (len(fa) + 1)
    counts = sizes.tolist()
    while heap and held < want:
        _, i, j = heapq.heappop(heap)
        cell = row[i] * n2 + col[j]
        flags[cell] = True
        held += counts[cell]
        reach[i] = j + 1
        if j + 1 < len(sb) and (i == 0 or reach[i - 1] > j + 1):
            heapq.heappush(heap, (-(fa[i] + sb[j + 1]), i, j + 1))
        if i + 1 < len(fa) and reach[i + 1] == j:
            heapq.heappush(heap, (-(fa[i + 1] + sb[j]), i + 1, j))
    return flags


def best(q: np.ndarray, qid: np.ndarray, mask: np.ndarray, x: np.ndarray, xid: np.ndarray, cell: np.ndarray, k: int) -> Iterator[tuple]:
    """Per query: (candidate rows, exact scores) of its k best in the part."""
    rough = q @ x.T
    rough[~mask[:, cell]] = -np.inf
    rough[qid[:, None] == xid[None, :]] = -np.inf
    for i in range(len(q)):
        r = rough[i]
        limit = np.partition(r, len(r) - k)[len(r) - k] if len(r) > k else -np.inf
        c = np.flatnonzero((r >= limit - 1e-9 * (1 + abs(limit))) & (r > -np.inf)) if np.isfinite(limit) else np.flatnonzero(r > -np.inf)
        s = (x[c] * q[i]).sum(axis=1)
        o = np.lexsort((xid[c], -s))[:k]
        yield c[o], s[o]


def search(vectors: DataFrame, is_query: Column, k: int = 20, visit: float = VISIT, centroids: int = CENTROIDS, least: int = LEAST) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found for each query row."""
    spark = vectors.sparkSession
    out_schema = "query_id long, vec_id long, score double"
    with Stages(spark) as stages:
        rows = stages.write(usable(vectors).withColumn("query", is_query), "vectors")
        sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").toPandas()["embedding"]
        if not len(sample):
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        dim = int(sample.map(len).mode().iloc[0])
        x = np.array([v for v in sample if len(v) == dim], dtype=np.float64)
        half = (dim + 1) // 2
        c1, c2 = fit_codebook(x[:, :half], centroids), fit_codebook(x[:, half:], centroids) if dim > 1 else np.zeros((1, 0))
        n2 = len(c2)

        def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if len(pdf):
                    v = np.stack(pdf["embedding"].to_numpy())
                    yield pd.DataFrame({"vec_id": pdf["vec_id"], "query": pdf["query"], "cell": nearest(v[:, :half], c1) * n2 + nearest(v[:, half:], c2),
                                        "vec": [r.tobytes() for r in v]})

        indexed = stages.write(rows.filter(F.size("embedding") == dim).mapInPandas(index, "vec_id long, query boolean, cell int, vec binary"), "cells")
        # at most CENTROIDS ** 2 rows
        stats = indexed.groupBy("cell").agg(F.countDistinct(F.xxhash64("vec")).alias("texts"), F.count(F.lit(1)).alias("rows")).toPandas()
        distinct, size = np.zeros(len(c1) * n2, dtype=np.int64), np.zeros(len(c1) * n2, dtype=np.int64)
        distinct[stats["cell"]], size[stats["cell"]] = stats["texts"], stats["rows"]
        want = max(least, visit * distinct.sum())

        # first centroids are gathered into groups of about PART_ROWS rows; a larger one is dealt over several parts
        by_first = size.reshape(len(c1), n2).sum(1)
        group, parts_of, held = np.zeros(len(c1), dtype=np.int64), [], None
        n_parts = 0
        for i in np.argsort(by_first, kind="stable")[::-1]:
            if by_first[i] >= PART_ROWS or held is None or held + by_first[i] > PART_ROWS:
                parts_of.append((n_parts, max(1, -(-int(by_first[i]) // PART_ROWS))))
                n_parts += parts_of[-1][1]
                held = PART_ROWS if by_first[i] >= PART_ROWS else 0
            group[i] = len(parts_of) - 1
            held += by_first[i]

        def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                out = {"part": [], "kind": [], "id": [], "cell": [], "vec": [], "mask": []}
                for vec_id, query, cell, vec in zip(pdf["vec_id"], pdf["query"], pdf["cell"], pdf["vec"]):
                    first, n = parts_of[group[cell // n2]]
                    new = [(first + vec_id % n, 0, vec_id, cell, vec, None)]
                    if query:
                        v = np.frombuffer(vec)
                        flags = visited_cells(c1 @ v[:half], c2 @ v[half:], distinct, want)
                        mask = np.packbits(flags).tobytes()
                        for g in set(group[flags.reshape(len(c1), n2).any(1)].tolist()):
                            new += [(parts_of[g][0] + s, 1, vec_id, cell, vec, mask) for s in range(parts_of[g][1])]
                    for values in zip(out.values(), zip(*new)):
                        values[0].extend(values[1])
                yield pd.DataFrame(out)

        def rerank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held: list[tuple] = []
            part, x, xid, cell = None, None, None, None
            for pdf in batches:
                for p, rows_ in pdf.groupby("part", sort=True):
                    if p != part:
                        part, held, x = p, [], None
                    new = rows_[rows_["kind"] == 0]
                    if len(new):
                        held.append((np.frombuffer(b"".join(new["vec"])).reshape(-1, dim), new["id"].to_numpy(), new["cell"].to_numpy()))
                    ask = rows_[rows_["kind"] == 1]
                    if not len(ask) or not held:
                        continue
                    if x is None:
                        x, xid, cell = (np.concatenate(z) for z in zip(*held))
                    for a in range(0, len(ask), QUERIES_AT_ONCE):
                        some = ask.iloc[a:a + QUERIES_AT_ONCE]
                        q = np.frombuffer(b"".join(some["vec"])).reshape(-1, dim)
                        mask = np.unpackbits(np.frombuffer(b"".join(some["mask"]), np.uint8).reshape(len(some), -1), axis=1)[:, :len(c1) * n2].astype(bool)
                        qid = some["id"].to_numpy()
                        found = list(best(q, qid, mask, x, xid, cell, k))
                        yield pd.DataFrame({"query_id": np.repeat(qid, [len(c) for c, _ in found]),
                                            "vec_id": np.concatenate([xid[c] for c, _ in found]), "score": np.concatenate([s for _, s in found])})

        dealt = indexed.mapInPandas(route, "part int, kind int, id long, cell int, vec binary, mask binary")
        near = stages.write(dealt.repartition(n_parts, "part").sortWithinPartitions("part", "kind", "id").mapInPandas(rerank, out_schema), "nearest", keep=True)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
