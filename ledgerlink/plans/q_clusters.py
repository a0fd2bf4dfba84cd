"""Registered queries: k-means, representatives, titles, projection, cluster join."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlink.functions import text as TX
from ledgerlink.functions import vectors as V
from ledgerlink.functions.cols import round_half_away
from ledgerlink.operators import clusters as CL
from ledgerlink.operators.matching import join_back
from ledgerlink.plans import bindings as B
from ledgerlink.plans.registry import register
from ledgerlink.session import materialize

S = B.SPEC


def R(col, d):
    return round_half_away(F.col(col) if isinstance(col, str) else col, d)


def _emb(spark, sf):
    return B.table(spark, sf, "embeddings")


SQL_E = "e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
SQL_LONG = """u AS (SELECT vec_id, label, unnest(v) AS x, unnest(generate_series(1, len(v))) AS pos FROM e),
cm AS (SELECT label AS cluster, pos, avg(x) AS mx FROM u GROUP BY label, pos),
d AS (SELECT u.vec_id, u.label, cm.cluster, sum((u.x - cm.mx) * (u.x - cm.mx)) AS sqdist
      FROM u JOIN cm ON cm.pos = u.pos GROUP BY u.vec_id, u.label, cm.cluster)"""


@register("kmeans_fit")
def kmeans_fit(spark, sf):
    """M2: k-means (k = 12) over all vectors; rows-only check, properties in tests."""
    assigned, _ = CL.kmeans_fit(_emb(spark, sf), "vec_id", "embedding", S.n_clusters, seed=42)
    return assigned


BLOCKS = 4


def _sql_minibatch() -> str:
    """Partial fits over BLOCKS blocks, one group of tables each."""
    sq = "list_sum(list_transform(list_zip({v}, {c}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"

    def nearest(rows: str, cents: str) -> str:
        d = sq.format(v="r.v", c="k.c")
        return f"SELECT vec_id, any_value(v) AS v, arg_min(cluster, (round(d, 9), cluster)) AS cluster, min(d) AS sqdist FROM (SELECT r.vec_id, r.v, k.cluster, {d} AS d FROM {rows} r, {cents} k) GROUP BY vec_id"

    steps = [f"""r AS (SELECT vec_id, v, CAST(floor((row_number() OVER (ORDER BY vec_id) - 1) / greatest(1, ceil(count(*) OVER () / {BLOCKS}.0))) AS INT) AS b FROM e),
c0 AS (SELECT row_number() OVER (ORDER BY md5(CAST(vec_id AS VARCHAR)), vec_id) - 1 AS cluster, CAST(0 AS BIGINT) AS n, v AS c FROM e QUALIFY cluster < {S.n_clusters})"""]
    for b in range(BLOCKS):
        steps.append(f"""a{b} AS MATERIALIZED ({nearest(f"(SELECT * FROM r WHERE b = {b})", f"c{b}")}),
s{b} AS (SELECT cluster, pos, sum(x) AS s, count(*) AS m FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{b}) GROUP BY cluster, pos),
v{b} AS (SELECT cluster, list(s ORDER BY pos) AS s, any_value(m) AS m FROM s{b} GROUP BY cluster),
c{b + 1} AS MATERIALIZED (SELECT k.cluster, k.n + coalesce(v.m, 0) AS n,
  CASE WHEN v.m IS NULL THEN k.c ELSE list_transform(list_zip(k.c, v.s), lambda z: (z[1] * k.n + z[2]) / (k.n + v.m)) END AS c
  FROM c{b} k LEFT JOIN v{b} v ON v.cluster = k.cluster)""")
    steps.append(f"f AS ({nearest('e', f'c{BLOCKS}')})")
    return ", ".join(steps)


@register("kmeans_minibatch", B.with_sql(SQL_E, _sql_minibatch(), f"""
SELECT f.vec_id, f.cluster, round(f.sqdist, 6) AS sqdist, CAST(k.n AS BIGINT) AS rows_taken_in FROM f JOIN c{BLOCKS} k ON k.cluster = f.cluster"""))
def kmeans_minibatch(spark, sf):
    """M2: partial fits over four ordered blocks of all vectors, then every
    vector's nearest centroid."""
    e = _emb(spark, sf)
    n = e.count()
    a, cents = CL.minibatch_fit(e, "vec_id", "embedding", S.n_clusters, block_rows=max(1, -(-n // BLOCKS)), max_blocks=BLOCKS)
    return join_back(a, cents.select("cluster", F.col("n").alias("rows_taken_in")), "cluster").select("vec_id", "cluster", R("sqdist", 6).alias("sqdist"), "rows_taken_in")


@register("kmeans_step", B.with_sql(SQL_E, SQL_LONG, """
SELECT vec_id, arg_min(cluster, (round(sqdist, 9), cluster)) AS cluster, round(min(sqdist), 6) AS sqdist
FROM d GROUP BY vec_id"""))
def kmeans_step(spark, sf):
    """M2, one exact Lloyd assignment: every vector to the nearest label mean."""
    e = _emb(spark, sf)
    cents = CL.group_means(e, "embedding", "label")          # k rows
    a = CL.assign_nearest(e, "vec_id", "embedding", cents)
    return a.select("vec_id", "cluster", R("sqdist", 6).alias("sqdist"))


@register("cluster_reps_nearest", B.with_sql(SQL_E, SQL_LONG, f"""
SELECT label, CAST(rank AS BIGINT) AS rank, vec_id, round(sqdist, 6) AS sqdist FROM (
  SELECT label, vec_id, sqdist, row_number() OVER (PARTITION BY label ORDER BY round(sqdist, 9), vec_id) AS rank
  FROM d WHERE cluster = label) WHERE rank <= {S.reps_per_cluster}"""))
def cluster_reps_nearest(spark, sf):
    """M3(a): 10 representatives per cluster, nearest to its centroid."""
    e = _emb(spark, sf)
    cents = V.mean_vectors(e, "embedding", ["label"]).drop("n")
    r = CL.nearest_representatives(e, "vec_id", "embedding", "label", cents, S.reps_per_cluster)
    return r.select("label", "rank", "vec_id", R("sqdist", 6).alias("sqdist"))


SUB_STEPS = 5


def _sql_subclusters() -> str:
    """Lloyd steps on (cluster, sub-centroid) keys."""
    k, parts = S.reps_per_cluster, [f"""size AS (SELECT label, count(*) AS n FROM e GROUP BY label),
o AS (SELECT e.*, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(vec_id AS VARCHAR)), vec_id) - 1 AS i FROM e),
c0 AS (SELECT label, i AS sub, v AS c FROM o WHERE i < {S.reps_per_cluster})"""]
    d = "list_sum(list_transform(list_zip(e.v, k.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for i in range(SUB_STEPS + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT vec_id, label, any_value(v) AS v, arg_min(sub, (d, sub)) AS sub, min(d) AS d
  FROM (SELECT e.vec_id, e.label, e.v, k.sub, {d} AS d FROM e JOIN c{i} k ON k.label = e.label) GROUP BY vec_id, label)""")
        if i < SUB_STEPS:
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT label, sub, list(m ORDER BY pos) AS c FROM (
  SELECT label, sub, pos, avg(x) AS m FROM (SELECT label, sub, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{i}) GROUP BY label, sub, pos) GROUP BY label, sub)""")
    return ", ".join(parts) + f""",
reps AS (SELECT label, sub, arg_min(vec_id, (d, vec_id)) AS vec_id, min(d) AS d FROM a{SUB_STEPS} JOIN size USING (label) WHERE n > {k} GROUP BY label, sub
  UNION ALL SELECT label, i, vec_id, 0.0 FROM o JOIN size USING (label) WHERE n <= {k})"""


@register("cluster_reps_subcluster", B.with_sql(SQL_E, _sql_subclusters(), "SELECT label, CAST(sub AS BIGINT) AS sub, vec_id, round(d, 6) AS sqdist FROM reps"))
def cluster_reps_subcluster(spark, sf):
    """M3(b): per cluster the row nearest to each of 10 sub-centroids."""
    r = CL.subcluster_representatives(_emb(spark, sf), "vec_id", "embedding", "label", k_sub=S.reps_per_cluster, iters=SUB_STEPS)
    return r.select("label", "sub", "vec_id", R("sqdist", 6).alias("sqdist"))


def _sql_tokens(x, min_len=3):
    return f"list_filter(regexp_split_to_array(lower({x}), '[^\\p{{L}}]+'), lambda s: length(s) >= {min_len})"


SQL_TITLES = f"""toks AS (SELECT source AS cl, unnest({_sql_tokens('text')}) AS term FROM documents),
tf AS (SELECT cl, term, count(*) AS tf FROM toks GROUP BY cl, term),
k AS (SELECT CAST(count(DISTINCT cl) AS DOUBLE) AS k FROM tf),
dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
sc AS (SELECT cl, tf.term, tf * ln(k / df) AS score FROM tf JOIN dfq USING (term), k),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cl ORDER BY round(score, 9) DESC, term) AS r FROM sc)
        WHERE r <= 5),
titles AS (SELECT cl AS source,
       string_agg(term, ' ' ORDER BY r) FILTER (WHERE r <= 3) AS cluster_title,
       string_agg(term, ', ' ORDER BY r) AS cluster_description FROM top GROUP BY cl)"""


@register("cluster_titles", "WITH " + SQL_TITLES + "\nSELECT * FROM titles")
def cluster_titles(spark, sf):
    """M4: a title and a description per document cluster (the source)."""
    return CL.cluster_titles(B.table(spark, sf, "documents"), "source", "text")


@register("attach_clusters", "WITH " + SQL_TITLES + r""",
nt AS (SELECT doc_id, source, regexp_replace(regexp_replace(regexp_replace(strip_accents(text),
         '[^\x00-\x7F]+', '', 'g'), '[\x{0009}-\x{000D}\x{001C}-\x{0020}]+', ' ', 'g'), '^ +| +$', '', 'g') AS norm
       FROM documents),
ct AS (SELECT norm, min(source) AS source FROM nt GROUP BY norm)
SELECT nt.doc_id, ct.source AS cluster, t.cluster_title
FROM nt LEFT JOIN ct ON ct.norm = nt.norm LEFT JOIN titles t ON t.source = ct.source""")
def attach_clusters(spark, sf):
    """Clusters are keyed by the *normalised* text on both sides (Q4):
    one cluster per distinct normal form, then titles joined by cluster id."""
    d = B.table(spark, sf, "documents")
    titles = CL.cluster_titles(d, "source", "text").select(F.col("source").alias("cluster"), "cluster_title")
    # one normalising pass over the documents; keys and hashes only are written
    nt = materialize(d.select("doc_id", "source", F.md5(TX.normalize_text("text")).alias("norm")), "normalised-docs")
    per_text = nt.groupBy("norm").agg(F.min("source").alias("cluster"))
    x = join_back(nt.select("doc_id", "norm"), per_text, "norm", "left", stage="clusters-per-text")
    return join_back(x, titles, "cluster", "left", stage="cluster-titles").select(
        "doc_id", "cluster", "cluster_title")


@register("project_2d")
def project_2d(spark, sf):
    """PCA to two dimensions (rows-only check)."""
    return CL.project_2d(_emb(spark, sf), "vec_id", "embedding")
