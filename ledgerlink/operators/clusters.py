"""Clustering of records and cluster descriptions.

* ``kmeans_fit``        distributed k-means (``pyspark.ml``), full Lloyd passes.
* ``minibatch_fit``     partial fits over ordered blocks of rows, each centroid
                        moving less the more rows it has taken in; centroids
                        are a stored table of any number of rows.
* ``nearest_centroids`` one exact assignment against such a table.
* ``assign_nearest``    one exact assignment step against given centroids
                        (at most k rows, held as a literal), checkable by SQL.
* ``nearest_representatives``  the n rows closest to their cluster centroid;
                        a ``row_number`` filter, planned with a partial
                        ``WindowGroupLimit`` so a big cluster sends n rows per
                        map task, not all its rows.
* ``subcluster_representatives``  the reference runs k-means inside every
                        cluster in one process; here Lloyd iterations run on
                        (cluster, sub-centroid) keys with partial aggregation,
                        and the small centroid table (clusters x k_sub rows) is
                        broadcast and checkpointed each iteration.
* ``cluster_titles``    distinctive terms per cluster by tf x log(K/df) instead
                        of a language-model call.
* ``project_2d``        PCA to two dimensions (stands in for t-SNE).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlink.functions import text as TX
from ledgerlink.functions import vectors as V
from ledgerlink.functions.cols import c, round_half_away
from ledgerlink.session import bounded_broadcast, materialize

MAX_LITERAL_CENTROIDS = 4096
CENTROID_ROWS = 100_000


def kmeans_fit(df: DataFrame, id_col: str, vec_col: str, k: int, seed: int = 42,
               max_iter: int = 20) -> tuple[DataFrame, object]:
    """M2: (id, cluster) for every row, and the fitted model."""
    x = df.select(c(id_col), array_to_vector(V.as_double_vector(vec_col)).alias("features"))
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features",
                   predictionCol="cluster").fit(x)
    return model.transform(x).select(c(id_col), F.col("cluster").cast("long").alias("cluster")), model


def assign_nearest(df: DataFrame, id_col: str, vec_col: str,
                   centroids: list[tuple[int, list[float]]]) -> DataFrame:
    """(id, cluster, sqdist): nearest centroid by squared distance, lower
    cluster id on ties. ``centroids`` is bounded by k."""
    if len(centroids) > MAX_LITERAL_CENTROIDS:
        raise ValueError("too many centroids for a literal assignment")
    arr = F.array(*[F.struct(F.lit(int(cid)).cast("long").alias("cid"),
                             F.array(*[F.lit(float(x)) for x in vec]).alias("c"))
                    for cid, vec in centroids])
    v = V.as_double_vector(vec_col)
    best = F.array_min(F.transform(arr, lambda s: F.struct(V.sq_distance(v, s["c"]).alias("d"),
                                                           s["cid"].alias("cid"))))
    return df.select(c(id_col), best["cid"].alias("cluster"), best["d"].alias("sqdist"))


CENTROID_BLOCK = 4096
PART_ROWS = 65_536


def _nearest(x: np.ndarray, cents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest centroid of each row; distances are
    rounded to 9 decimals for the choice, the lower index on ties. A matrix
    product finds the few that come into question; their distances are added up
    in a fixed order."""
    cc, n = (cents * cents).sum(axis=1), len(x)
    rough = cc[None, :] - 2.0 * (x @ cents.T)
    slack = 1e-8 + 1e-12 * (cc.max(initial=0.0) + (x * x).sum(axis=1))
    rows, cols = np.nonzero(rough <= rough.min(axis=1)[:, None] + slack[:, None])
    d = np.zeros(len(rows))
    for j in range(x.shape[1]):
        e = x[rows, j] - cents[cols, j]
        d += e * e
    key = np.floor(d * 1e9 + 0.5) / 1e9
    order = np.lexsort((cols, key, rows))
    first = order[np.unique(rows[order], return_index=True)[1]]
    return cols[first], d[first] if n else d


def nearest_centroids(rows: DataFrame, centroids: DataFrame) -> DataFrame:
    """(id columns of ``rows``, cluster, sqdist) for rows with a vector ``_v``: the
    nearest row (cluster, _c) of a stored centroid table of any size.

    Centroids are dealt to blocks of ``CENTROID_BLOCK``. One block travels with the
    task; of more, each row meets every block in a cogroup of part and block, and
    the best of its partial answers is kept. No pair of row and centroid is a row
    of a table."""
    spark = rows.sparkSession
    keep = [x for x in rows.columns if x != "_v"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "_v")
    schema = f"{kinds}, cluster long, sqdist double"

    def answer(pdf: pd.DataFrame, ids: np.ndarray, cents: np.ndarray) -> pd.DataFrame:
        out = pdf[keep].reset_index(drop=True)
        if not len(pdf) or not len(ids):
            return out.iloc[:0].assign(cluster=np.zeros(0, np.int64), sqdist=np.zeros(0))
        at, d = _nearest(np.stack(pdf["_v"].to_numpy()), cents)
        return out.assign(cluster=ids[at], sqdist=d)

    n = centroids.count()
    if n <= CENTROID_BLOCK:
        table = centroids.orderBy("cluster").toPandas()          # at most CENTROID_BLOCK rows
        ids = table["cluster"].to_numpy(dtype=np.int64)
        cents = np.stack(table["_c"].to_numpy()) if n else np.zeros((0, 0))

        def run(batches):
            for pdf in batches:
                yield answer(pdf, ids, cents)
        return rows.mapInPandas(run, schema)
    blocks = -(-n // CENTROID_BLOCK)
    parts = max(1, -(-rows.count() // PART_ROWS))
    numbered = rows.withColumn("_row", F.monotonically_increasing_id()).withColumn("_p", F.pmod(F.xxhash64("_row"), F.lit(parts)).cast("int"))
    q = materialize(numbered, "kmeans-rows").withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    t = centroids.withColumn("_b", F.pmod(F.xxhash64("cluster"), F.lit(blocks)).cast("int")).withColumn("_p", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def meet(qp: pd.DataFrame, tp: pd.DataFrame) -> pd.DataFrame:
        tp = tp.sort_values("cluster")
        out = answer(qp, tp["cluster"].to_numpy(dtype=np.int64), np.stack(tp["_c"].to_numpy()) if len(tp) else np.zeros((0, 0)))
        return out.assign(_row=qp["_row"].to_numpy()[:len(out)])

    partial = q.groupBy("_p", "_b").cogroup(t.groupBy("_p", "_b")).applyInPandas(meet, schema + ", _row long")
    best = partial.groupBy("_row").agg(F.min(F.struct(round_half_away(F.col("sqdist"), 9).alias("k"), "cluster", "sqdist")).alias("m"))
    out = q.where("_b = 0").select(*[c(x) for x in keep], "_row").join(best, "_row")
    return out.select(*[c(x) for x in keep], F.col("m.cluster").alias("cluster"), F.col("m.sqdist").alias("sqdist"))


def start_rows(df: DataFrame, id_col: str, vec_col: str, k: int) -> DataFrame:
    """(cluster, _c): the k rows whose ids have the smallest MD5, numbered from 0 in
    that order; a distributed top-k."""
    key = F.md5(c(id_col).cast("string"))
    w = Window.orderBy("_k", "_id")                               # over k rows
    top = df.select(key.alias("_k"), c(id_col).alias("_id"), V.as_double_vector(vec_col).alias("_c")).orderBy("_k", "_id").limit(k)
    return top.select((F.row_number().over(w) - 1).cast("long").alias("cluster"), "_c")


def minibatch_fit(df: DataFrame, id_col: str, vec_col: str, k: int, block_rows: int = 10_000, max_blocks: int = 64,
                  start: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """M2: mini-batch k-means. ((id, cluster, sqdist) of every row, the centroids as
    a stored table (cluster, n, _c)).

    Rows are cut into consecutive blocks of ``block_rows`` in the order of their
    ids (longer ones, where that would be more than ``max_blocks``: blocks are
    fitted one after the other). A partial fit gives each row of a block its
    nearest centroid; a centroid that had taken in n rows and gets m more moves to
    (n * centroid + sum of the m) / (n + m). ``start`` (cluster, _c) names the
    first centroids; by default they are ``start_rows``. Blocks are folders of one
    stored table, so a partial fit reads its block only; a task adds up one vector
    a centroid. Rows without a vector take no part."""
    from ledgerlink.operators.relational import global_order_index
    from ledgerlink.session import scratch_path
    spark = df.sparkSession
    vectors = df.select(c(id_col), V.as_double_vector(vec_col).alias("_v")).where(F.col("_v").isNotNull())
    placed = global_order_index(vectors, [id_col])
    n = placed.count()
    rows = max(block_rows, -(-n // max_blocks), 1)
    path = scratch_path(spark, "kmeans-blocks")
    placed.withColumn("_block", F.floor(F.col("_gidx") / F.lit(rows)).cast("int")).drop("_gidx").write.partitionBy("_block").parquet(path)
    first = (start if start is not None else start_rows(df.where(c(vec_col).isNotNull()), id_col, vec_col, k)).select("cluster", "_c")
    cents = materialize(first.withColumn("n", F.lit(0).cast("long")), "centroids")
    if not n:
        return nearest_centroids(vectors, cents.limit(0)), cents
    blocks = spark.read.parquet(path)
    for b in range(-(-n // rows)):
        given = nearest_centroids(blocks.where(F.col("_block") == b).select("_v", F.col("_v").alias("_x")), cents)
        means = V.mean_vectors(given, "_x", ["cluster"]).withColumnRenamed("n", "_m")
        j = cents.join(means, "cluster", "left")
        total = F.col("n") + F.col("_m")
        moved = F.zip_with("_c", "_x", lambda a, x: (a * F.col("n") + x * F.col("_m")) / total)
        cents = materialize(j.select("cluster", F.when(F.col("_m").isNull(), F.col("_c")).otherwise(moved).alias("_c"),
                                     F.coalesce(total, "n").cast("long").alias("n")), "centroids")
    return nearest_centroids(vectors, cents), cents


def group_means(df: DataFrame, vec_col: str, group_col: str) -> list[tuple[int, list[float]]]:
    """Mean vector per group, collected (one row per group: bounded by k)."""
    rows = V.mean_vectors(df, vec_col, [group_col]).orderBy(group_col).collect()
    return [(r[group_col], list(r[vec_col])) for r in rows]


def nearest_representatives(df: DataFrame, id_col: str, vec_col: str, cluster_col: str,
                            centroids: DataFrame, n: int) -> DataFrame:
    """M3(a): the ``n`` rows closest to their cluster's centroid.
    ``centroids`` is (cluster, vector), one row per cluster (broadcast)."""
    cent = bounded_broadcast(centroids.select(c(cluster_col), V.as_double_vector(vec_col).alias("_cv")), CENTROID_ROWS)
    x = df.select(c(id_col), c(cluster_col), V.as_double_vector(vec_col).alias("_v")).join(cent, cluster_col)
    x = x.withColumn("sqdist", V.sq_distance(F.col("_v"), F.col("_cv")))
    w = Window.partitionBy(cluster_col).orderBy(round_half_away(F.col("sqdist"), 9), c(id_col))
    return (x.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= n)
            .select(c(cluster_col), "rank", c(id_col), "sqdist"))


def subcluster_representatives(df: DataFrame, id_col: str, vec_col: str, cluster_col: str,
                               k_sub: int = 10, iters: int = 5) -> DataFrame:
    """M3(b): per cluster, the row nearest to each of ``k_sub`` sub-centroids
    (all rows when the cluster has at most ``k_sub``). Returns
    (cluster, sub, id, sqdist)."""
    base = df.select(c(id_col).alias("_id"), c(cluster_col).alias("_cl"),
                     V.as_double_vector(vec_col).alias("_v"))
    # deterministic start: the k_sub rows of smallest hash in each cluster
    w0 = Window.partitionBy("_cl").orderBy(F.md5(F.col("_id").cast("string")), "_id")
    cent = (base.withColumn("_sub", F.row_number().over(w0) - 1).where(F.col("_sub") < k_sub)
            .select("_cl", "_sub", "_v"))

    def as_table(cdf: DataFrame) -> DataFrame:
        t = cdf.groupBy("_cl").agg(F.collect_list(F.struct("_sub", F.col("_v").alias("c"))).alias("_cs"))
        return materialize(t, "sub-centroids")   # clusters x k_sub vectors

    def assign(tbl: DataFrame) -> DataFrame:
        x = base.join(bounded_broadcast(tbl, CENTROID_ROWS), "_cl")
        best = F.array_min(F.transform("_cs", lambda s: F.struct(V.sq_distance(F.col("_v"), s["c"]).alias("d"),
                                                                 s["_sub"].alias("sub"))))
        return x.select("_id", "_cl", "_v", best["sub"].alias("_sub"), best["d"].alias("_d"))

    tbl = as_table(cent)
    for _ in range(iters):
        a = assign(tbl)
        means = V.mean_vectors(a, "_v", ["_cl", "_sub"]).drop("n")
        tbl = as_table(means)
    # a cluster of at most k_sub rows is represented by all of them, equal vectors included
    size = base.groupBy("_cl").agg(F.count(F.lit(1)).alias("_n"))
    few = size.where(F.col("_n") <= k_sub).select("_cl")
    a = assign(tbl).join(few, "_cl", "left_anti")
    reps = a.groupBy("_cl", "_sub").agg(F.min(F.struct("_d", "_id")).alias("_m"))
    whole = (base.join(few, "_cl").withColumn("_sub", F.row_number().over(w0) - 1)
             .select("_cl", "_sub", F.struct(F.lit(0.0).alias("_d"), "_id").alias("_m")))
    reps = reps.unionByName(whole)
    return reps.select(F.col("_cl").alias(cluster_col), F.col("_sub").cast("long").alias("sub"),
                       F.col("_m._id").alias(id_col), F.col("_m._d").alias("sqdist"))


def cluster_titles(df: DataFrame, cluster_col: str, text_col: str, n_title: int = 3,
                   n_desc: int = 5, min_len: int = 3) -> DataFrame:
    """M4: title (top ``n_title`` terms) and description (top ``n_desc``) per
    cluster; term score = tf(cluster, term) x ln(K / df(term)), ties by term."""
    toks = TX.token_rows(df.select(c(cluster_col).alias("_cl"), c(text_col).alias("_t")), "_t", min_len,
                         keep=["_cl"])
    # term counts per cluster, written once: the cluster count, document
    # frequencies and scores all read this stage instead of re-tokenising
    tf = materialize(toks.groupBy("_cl", "term").agg(F.count(F.lit(1)).alias("tf")), "term-counts")
    k = tf.select(F.countDistinct("_cl").cast("double")).scalar()     # scalar subquery, no action
    dfreq = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    sc = tf.join(dfreq, "term").withColumn("score", F.col("tf") * F.log(k / F.col("df")))
    w = Window.partitionBy("_cl").orderBy(F.desc(round_half_away(F.col("score"), 9)), "term")
    top = sc.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= max(n_title, n_desc))
    g = top.groupBy("_cl").agg(F.sort_array(F.collect_list(F.struct("_r", "term"))).alias("_t"))
    terms = F.transform("_t", lambda s: s["term"])
    return g.select(F.col("_cl").alias(cluster_col),
                    F.array_join(F.slice(terms, 1, n_title), " ").alias("cluster_title"),
                    F.array_join(F.slice(terms, 1, n_desc), ", ").alias("cluster_description"))


def project_2d(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """First two principal components of the vectors."""
    x = df.select(c(id_col), array_to_vector(V.as_double_vector(vec_col)).alias("features"))
    model = PCA(k=2, inputCol="features", outputCol="pc").fit(x)
    y = model.transform(x).select(c(id_col), vector_to_array("pc").alias("pc"))
    return y.select(c(id_col), F.col("pc")[0].alias("x"), F.col("pc")[1].alias("y"))
