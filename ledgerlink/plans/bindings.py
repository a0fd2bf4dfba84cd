"""Bindings of the job roles to the driver's test tables.

Every derived table is written twice, once as a Spark builder and once as a
SQL fragment for the DuckDB oracle, next to each other so the two stay equal.
All numbers are computed in double precision in the same operation order on
both sides.

purchase line   lineitem ⋈ orders ⋈ customer ⋈ part
currency        by customer nation: EUR, USD, CHF, XOF
rates           closed formulas over the job period's months (CHF published
                from 1996-01 on; XOF never, so it takes the fallback)
price index     100 + 0.25 per month since 1995-01
catalogue       one row per (p_type, p_brand) with a leaf code such as EC17x
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.functions.dates import month_start
from ledgerlink.session import session_key
from ledgerlink.spec import JobSpec

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

SPEC = JobSpec()

# Fixed values of the binding: currencies by nation, rate formulas, index formula.
CURRENCIES = ["EUR", "USD", "CHF", "XOF"]
CHF_FIRST_MONTH = dt.date(1996, 1, 1)
INDEX_ORIGIN = dt.date(1995, 1, 1)


_TABLES: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table (read-only input), read once per session: opening a Parquet
    source lists files and reads footers eagerly, so the DataFrame is reused."""
    key = (session_key(spark), sf_dir, name)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _TABLES[key]


def with_sql(*parts: str) -> str:
    """Compose ``WITH a AS (...), b AS (...) <body>``; the last part is the body.

    The body may itself start with further ``name AS (...)`` definitions before
    its final ``SELECT`` line."""
    *ctes, body = parts
    ctes = [x.strip() for x in ctes]
    b = body.strip()
    if not re.match(r"(?i)select\b", b):
        m = list(re.finditer(r"\)\s*\n\s*SELECT\b", b))[-1]
        ctes.append(b[:m.start() + 1])
        b = b[m.start() + 1:].strip()
    return ("WITH " + ",\n".join(ctes) + "\n" + b) if ctes else b


# ------------------------------------------------------------------- codes

def leaf_code(p_type: Column, p_brand: Column) -> Column:
    return F.concat(F.substring(p_type, 1, 2),
                    F.lpad(F.regexp_extract(p_brand, r"#(\d+)", 1), 2, "0"), F.lit("x"))


SQL_LEAF_CODE = "(substr(p_type, 1, 2) || lpad(regexp_extract(p_brand, '#(\\d+)', 1), 2, '0') || 'x')"


def currency_of(nationkey: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in CURRENCIES]), F.pmod(nationkey, F.lit(4)) + 1)


SQL_CURRENCY = ("(CASE c_nationkey % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' "
                "WHEN 2 THEN 'CHF' ELSE 'XOF' END)")


# --------------------------------------------------------------- purchases

def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    # orders ⋈ customer first: at scale (no broadcast) the customer join then
    # shuffles an orders-sized input, and the lineitem-sized stream is shuffled
    # only twice (by order key, by part key) instead of three times
    oc = o.join(cu, o.o_custkey == cu.c_custkey).select("o_orderkey", "o_orderpriority",
                                                       "c_nationkey", "c_mktsegment")
    j = (li.join(oc, li.l_orderkey == oc.o_orderkey)
         .join(p, li.l_partkey == p.p_partkey))
    return j.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_shipdate").alias("ship_date"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_quantity").alias("quantity"),
        currency_of(F.col("c_nationkey")).alias("currency"),
        F.col("o_orderpriority").alias("entity"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nationkey"),
        F.col("p_name").alias("article"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        leaf_code(F.col("p_type"), F.col("p_brand")).alias("cat_code"))


SQL_PURCHASES = f"""purchases AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate AS ship_date,
         l_extendedprice AS amount, l_quantity AS quantity, {SQL_CURRENCY} AS currency,
         o_orderpriority AS entity, c_mktsegment AS segment, c_nationkey AS nationkey,
         p_name AS article, p_type AS category, p_brand AS brand, {SQL_LEAF_CODE} AS cat_code
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey
       JOIN part ON l_partkey = p_partkey)"""


# ------------------------------------------------------------ rates, index

def month_spine(spark: SparkSession, spec: JobSpec = SPEC) -> DataFrame:
    n = spec.months_in_period()
    return spark.range(n).select(
        F.add_months(F.lit(spec.period_start), F.col("id").cast("int")).alias("month"))


def _usd_eur(m: Column) -> Column:
    return F.lit(0.8) + F.lit(0.01) * F.month(m)


def _chf_eur(m: Column) -> Column:
    return F.lit(0.9) + F.lit(0.005) * F.month(m)


def rates(spark: SparkSession, spec: JobSpec = SPEC) -> DataFrame:
    """(month, currency, target, rate) towards EUR and USD."""
    m = month_spine(spark, spec)
    mc = F.col("month")
    chf_ok = mc >= F.lit(CHF_FIRST_MONTH)
    rows = [
        m.select(mc, F.lit("USD").alias("currency"), F.lit("EUR").alias("target"), _usd_eur(mc).alias("rate")),
        m.where(chf_ok).select(mc, F.lit("CHF"), F.lit("EUR"), _chf_eur(mc)),
        m.select(mc, F.lit("EUR"), F.lit("USD"), (F.lit(1.0) / _usd_eur(mc))),
        m.where(chf_ok).select(mc, F.lit("CHF"), F.lit("USD"), _chf_eur(mc) / _usd_eur(mc)),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out


def rates_max_rows(spec: JobSpec = SPEC) -> int:
    return spec.months_in_period() * 4


def _sql_months(spec: JobSpec = SPEC) -> str:
    return (f"SELECT CAST(m AS DATE) AS month FROM generate_series(DATE '{spec.period_start}', "
            f"DATE '{spec.period_end}', INTERVAL 1 MONTH) t(m)")


def sql_rates(spec: JobSpec = SPEC) -> str:
    usd = "(CAST(0.8 AS DOUBLE) + CAST(0.01 AS DOUBLE) * month(month))"
    chf = "(CAST(0.9 AS DOUBLE) + CAST(0.005 AS DOUBLE) * month(month))"
    ok = f"month >= DATE '{CHF_FIRST_MONTH}'"
    return f"""months AS ({_sql_months(spec)}),
rates AS (
  SELECT month, 'USD' AS currency, 'EUR' AS target, {usd} AS rate FROM months
  UNION ALL SELECT month, 'CHF', 'EUR', {chf} FROM months WHERE {ok}
  UNION ALL SELECT month, 'EUR', 'USD', CAST(1.0 AS DOUBLE) / {usd} FROM months
  UNION ALL SELECT month, 'CHF', 'USD', {chf} / {usd} FROM months WHERE {ok})"""


def price_index(spark: SparkSession, spec: JobSpec = SPEC) -> DataFrame:
    m = month_spine(spark, spec)
    k = (F.year("month") - INDEX_ORIGIN.year) * 12 + F.month("month") - 1
    return m.select("month", (F.lit(100.0) + F.lit(0.25) * k).alias("index"))


def sql_price_index(spec: JobSpec = SPEC) -> str:
    return f"""imonths AS ({_sql_months(spec)}),
price_index AS (
  SELECT month, CAST(100.0 AS DOUBLE) + CAST(0.25 AS DOUBLE) *
         ((year(month) - {INDEX_ORIGIN.year}) * 12 + month(month) - 1) AS index FROM imonths)"""


def sql_fx(target: str, amount: str = "p.amount", date: str = "p.ship_date", cur: str = "p.currency") -> tuple[str, str]:
    """(rate expression, join clause) for the oracle, mirroring ``fx_convert``."""
    alias = f"r_{target.lower()}"
    fallback = " WHEN {c} = 'XOF' THEN CAST(0.0015 AS DOUBLE)".format(c=cur) if target == "EUR" else ""
    rate = (f"(CASE WHEN {cur} = '{target}' THEN CAST(1.0 AS DOUBLE) "
            f"WHEN {alias}.rate IS NOT NULL THEN {alias}.rate{fallback} END)")
    join = (f"LEFT JOIN rates {alias} ON {alias}.target = '{target}' AND {alias}.currency = {cur} "
            f"AND {alias}.month = CAST(date_trunc('month', {date}) AS DATE)")
    return rate, join


def sql_deflator(date: str = "p.ship_date", spec: JobSpec = SPEC) -> tuple[str, str]:
    """(factor expression, join clause): index(month) / index(base January)."""
    factor = "(pi.index / pb.index)"
    join = (f"LEFT JOIN price_index pi ON pi.month = CAST(date_trunc('month', {date}) AS DATE) "
            f"JOIN price_index pb ON pb.month = DATE '{spec.base_year}-01-01'")
    return factor, join


# ---------------------------------------------------------------- catalogue

def money_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Emission-factor catalogue, one row per (p_type, p_brand)."""
    p = table(spark, sf_dir, "part")
    g = p.groupBy("p_type", "p_brand").agg(
        (F.avg("p_size") / F.lit(100.0)).alias("ef"),
        (F.min("p_retailprice") / F.lit(10000.0)).alias("unc_attr"),
        (F.max("p_retailprice") / F.lit(10000.0)).alias("unc_80"))
    return g.select(leaf_code(F.col("p_type"), F.col("p_brand")).alias("cat_code"),
                    F.concat_ws(" ", "p_type", "p_brand").alias("cat_description"),
                    F.col("p_type").alias("cat_type"), "ef", "unc_attr", "unc_80")


SQL_MONEY_CATALOGUE = f"""catalogue AS (
  SELECT {SQL_LEAF_CODE} AS cat_code, p_type || ' ' || p_brand AS cat_description,
         p_type AS cat_type, avg(p_size) / CAST(100.0 AS DOUBLE) AS ef,
         min(p_retailprice) / CAST(10000.0 AS DOUBLE) AS unc_attr,
         max(p_retailprice) / CAST(10000.0 AS DOUBLE) AS unc_80
  FROM part GROUP BY p_type, p_brand)"""


def month_of(col: str) -> Column:
    return month_start(col)
