"""Registered query: the whole job from raw purchase lines to the exported table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlink.functions import text as TX
from ledgerlink.functions.cols import round_half_away
from ledgerlink.plans import bindings as B
from ledgerlink.plans import report
from ledgerlink.plans.q_vectors import TOP_N, _sql_profile, _sql_tokens
from ledgerlink.plans.registry import register
from ledgerlink.session import scratch_path
from ledgerlink.sources import files as FS

S = B.SPEC
_RATE, _RATE_JOIN = B.sql_fx("EUR")
_DEFL, _DEFL_JOIN = B.sql_deflator()


def corrections(spark, sf):
    """Corrected categories by article; some articles have none."""
    p = B.table(spark, sf, "part")
    return p.groupBy(F.col("p_name").alias("article")).agg(
        F.when(F.col("p_name").contains("ring"), F.lit(None)).otherwise(F.max("p_type")).alias("category"))


_SCORE = f"CAST({S.w_cosine} AS DOUBLE) * sim + CAST({S.w_overlap} AS DOUBLE) * ov"

SQL_JOB = B.with_sql(B.SQL_PURCHASES, B.sql_rates(), B.sql_price_index(), B.SQL_MONEY_CATALOGUE, f"""
corr AS (SELECT p_name AS article, CASE WHEN contains(p_name, 'ring') THEN NULL ELSE max(p_type) END AS category FROM part GROUP BY p_name),
raw AS (SELECT DISTINCT * FROM purchases WHERE article IS NOT NULL OR category IS NOT NULL),
pur AS (SELECT raw.* EXCLUDE (category), coalesce(corr.category, raw.category) AS category FROM raw LEFT JOIN corr ON corr.article = raw.article),
job AS (SELECT *, coalesce(regexp_replace(article, '[0-9]+', '', 'g'), category, '') || ' ' || coalesce(lower(category), '') AS txt FROM pur),
cat AS (SELECT cat_code, cat_description, {_sql_profile('cat_description')} AS v, {_sql_tokens('cat_description')} AS tok FROM catalogue),
q AS (SELECT txt, {_sql_profile('txt')} AS v, {_sql_tokens('txt')} AS tok FROM (SELECT DISTINCT txt FROM job)),
pairs AS (SELECT q.txt, cat.cat_code, list_cosine_similarity(q.v, cat.v) AS sim,
                 CASE WHEN len(list_distinct(list_concat(q.tok, cat.tok))) = 0 THEN 0.0
                      ELSE len(list_intersect(q.tok, cat.tok)) / len(list_distinct(list_concat(q.tok, cat.tok))) END AS ov
          FROM q, cat),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY txt ORDER BY round(sim, 9) DESC, cat_code) AS rk FROM pairs) WHERE rk <= {TOP_N}),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY txt ORDER BY round({_SCORE}, 9) DESC, cat_code) AS r FROM top) WHERE r = 1),
res AS (SELECT p.l_orderkey, p.l_linenumber, b.cat_code AS matched_code, b.sim, p.amount * {_RATE} AS eur,
               p.amount * {_RATE} / {_DEFL} AS defl, k.ef, k.unc_attr + CAST(0.8 AS DOUBLE) * k.unc_80 AS unc
        FROM job p JOIN best b ON b.txt = p.txt {_RATE_JOIN} {_DEFL_JOIN} LEFT JOIN catalogue k ON k.cat_code = b.cat_code)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, matched_code, round(sim, 6) AS match_similarity,
       CAST(CASE WHEN round(sim, 9) < 0 THEN 1 ELSE least(floor(round(sim, 9) * 5) + 1, 5) END AS BIGINT) AS "Rating",
       CASE WHEN round(sim, 9) < 0 THEN 1 ELSE least(floor(round(sim, 9) * 5) + 1, 5) END = 1 AS "Flag",
       round(eur, 6) AS amount_eur, round(defl, 6) AS amount_deflated, round(defl * ef, 6) AS co2e, round(defl * ef * unc, 6) AS uncertainty
FROM res""")


@register("full_job", SQL_JOB)
def full_job(spark, sf):
    """Clean, correct, match, convert, deflate, rate, export, read back."""
    lines = B.purchases(spark, sf).select("l_orderkey", "l_linenumber", "ship_date", "amount", "quantity", "currency", "article", "category")
    x = report.full_job(lines, B.money_catalogue(spark, sf), corrections(spark, sf), B.rates(spark), B.price_index(spark), S,
                        article="article", category="category", code="cat_code", description="cat_description",
                        date_col="ship_date", cur_col="currency", amount_col="amount", embed=TX.char_profile, rates_rows=B.rates_max_rows())
    r = lambda name, d=6: round_half_away(F.col(name), d)
    path = scratch_path(spark, "job-result")
    FS.export_typed(x.select("l_orderkey", "l_linenumber", F.col("cat_code").alias("matched_code"), r("match_similarity").alias("match_similarity"),
                             "Rating", "Flag", r("amount_eur").alias("amount_eur"), r("amount_deflated").alias("amount_deflated"),
                             r("co2e").alias("co2e"), r("uncertainty_carbon_emissions").alias("uncertainty")), path)
    return spark.read.parquet(path)
