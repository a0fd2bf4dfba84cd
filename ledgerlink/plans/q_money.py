"""Registered queries: the flagship job, money measures, projections, dashboard."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlink.functions.cols import round_half_away as _rha
from ledgerlink.operators import money, relational
from ledgerlink.plans import bindings as B
from ledgerlink.plans import report
from ledgerlink.plans.registry import register

S = B.SPEC


def R(col, d):
    return _rha(F.col(col) if isinstance(col, str) else col, d)


def _lines(spark, sf):
    """Line-level result table over all purchase lines."""
    return report.emissions_lines(B.purchases(spark, sf), B.rates(spark), B.price_index(spark),
                                  B.money_catalogue(spark, sf), S, "cat_code", "ship_date",
                                  "currency", "amount", rates_rows=B.rates_max_rows())


_EUR_RATE, _EUR_JOIN = B.sql_fx("EUR")
_USD_RATE, _USD_JOIN = B.sql_fx("USD")
_DEFL, _DEFL_JOIN = B.sql_deflator()

SQL_LINES = f"""lines AS (
  SELECT p.*, {_EUR_RATE} AS rate_eur, p.amount * {_EUR_RATE} AS amount_eur,
         {_USD_RATE} AS rate_usd, p.amount * {_USD_RATE} AS amount_usd,
         p.amount * {_EUR_RATE} / {_DEFL} AS amount_deflated,
         k.cat_description, k.cat_type, k.ef, k.unc_attr, k.unc_80
  FROM purchases p {_EUR_JOIN} {_USD_JOIN} {_DEFL_JOIN}
       LEFT JOIN catalogue k ON k.cat_code = p.cat_code),
lines2 AS (
  SELECT *, amount_deflated * ef AS co2e,
         unc_attr + CAST(0.8 AS DOUBLE) * unc_80 AS total_uncertainty_factor,
         amount_deflated * ef * (unc_attr + CAST(0.8 AS DOUBLE) * unc_80) AS uncertainty_carbon_emissions
  FROM lines)"""

_CTES = (B.SQL_PURCHASES, B.sql_rates(), B.sql_price_index(), B.SQL_MONEY_CATALOGUE, SQL_LINES)


def _with(body: str) -> str:
    return B.with_sql(*_CTES, body)


# ------------------------------------------------------------------ M14 flagship

def emissions_report(spark, sf):
    return report.emissions_summary(
        B.purchases(spark, sf), B.rates(spark), B.price_index(spark), B.money_catalogue(spark, sf),
        S, "cat_code", "ship_date", "currency", "amount", ["category", "year"],
        rates_rows=B.rates_max_rows())


register("emissions_report", _with("""
SELECT category, CAST(year(ship_date) AS BIGINT) AS year, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(sum(CASE WHEN rate_eur IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_quarantined,
       round(sum(amount_eur), 2) AS amount_eur, round(sum(amount_deflated), 2) AS amount_deflated,
       round(sum(co2e), 2) AS co2e_kg, round(sum(uncertainty_carbon_emissions), 2) AS uncertainty_kg
FROM lines2 GROUP BY category, year(ship_date)"""))(emissions_report)


# ------------------------------------------------------------------ S4, S5, D1-D7

@register("fx_rates", _with("""
SELECT l_orderkey, l_linenumber, currency, strftime(date_trunc('month', ship_date), '%Y-%m-%d') AS month,
       rate_eur, rate_eur IS NULL AS fx_quarantined FROM lines2"""))
def fx_rates(spark, sf):
    x = money.fx_convert(B.purchases(spark, sf), B.rates(spark), "ship_date", "currency", "amount",
                         "EUR", out_col="amount_eur", rate_col="rate_eur",
                         known_max_rows=B.rates_max_rows())
    return x.select("l_orderkey", "l_linenumber", "currency",
                    F.date_format(F.trunc(F.to_date("ship_date"), "MM"), "yyyy-MM-dd").alias("month"),
                    "rate_eur", "fx_quarantined")


@register("price_index_range", B.with_sql(B.SQL_PURCHASES, B.sql_price_index(), """b AS (
  SELECT CAST(date_trunc('month', min(ship_date)) AS DATE) AS lo,
         CAST(date_trunc('month', max(ship_date)) AS DATE) AS hi FROM purchases)""", f"""
SELECT strftime(month, '%Y-%m-%d') AS month, index FROM price_index, b
WHERE month BETWEEN least(lo, DATE '{S.base_year}-01-01') AND greatest(hi, DATE '{S.base_year}-01-01')"""))
def price_index_range(spark, sf):
    li = B.table(spark, sf, "lineitem")
    # scalar subqueries: evaluated once, no join with the index table
    lo = li.select(F.trunc(F.to_date(F.min("l_shipdate")), "MM")).scalar()
    hi = li.select(F.trunc(F.to_date(F.max("l_shipdate")), "MM")).scalar()
    base = F.lit(f"{S.base_year}-01-01").cast("date")
    return money.price_index_range(B.price_index(spark), F.least(lo, base),
                                   F.greatest(hi, base)).select(
        F.date_format("month", "yyyy-MM-dd").alias("month"), "index")


@register("fx_convert", _with("""
SELECT l_orderkey, l_linenumber, round(amount_eur, 6) AS amount_eur FROM lines2"""))
def fx_convert(spark, sf):
    x = money.fx_convert(B.purchases(spark, sf), B.rates(spark), "ship_date", "currency", "amount", "EUR",
                         out_col="amount_eur", rate_col="rate_eur", known_max_rows=B.rates_max_rows())
    return x.select("l_orderkey", "l_linenumber", R("amount_eur", 6).alias("amount_eur"))


@register("deflate", _with("""
SELECT l_orderkey, l_linenumber, round(amount_deflated, 6) AS amount_deflated FROM lines2"""))
def deflate(spark, sf):
    return _lines(spark, sf).select("l_orderkey", "l_linenumber",
                                    R("amount_deflated", 6).alias("amount_deflated"))


@register("co2e_money", _with("""
SELECT l_orderkey, l_linenumber, cat_code, round(co2e, 6) AS co2e FROM lines2"""))
def co2e_money(spark, sf):
    return _lines(spark, sf).select("l_orderkey", "l_linenumber", "cat_code", R("co2e", 6).alias("co2e"))


@register("fx_second_currency", _with("""
SELECT l_orderkey, l_linenumber, currency, round(amount_usd, 6) AS amount_usd FROM lines2"""))
def fx_second_currency(spark, sf):
    x = money.fx_convert(B.purchases(spark, sf), B.rates(spark), "ship_date", "currency", "amount", "USD",
                         out_col="amount_usd", rate_col="rate_usd", known_max_rows=B.rates_max_rows())
    return x.select("l_orderkey", "l_linenumber", "currency", R("amount_usd", 6).alias("amount_usd"))


@register("uncertainty", _with("""
SELECT l_orderkey, l_linenumber, round(total_uncertainty_factor, 9) AS total_uncertainty_factor,
       round(uncertainty_carbon_emissions, 6) AS uncertainty_carbon_emissions FROM lines2"""))
def uncertainty(spark, sf):
    return _lines(spark, sf).select(
        "l_orderkey", "l_linenumber", R("total_uncertainty_factor", 9).alias("total_uncertainty_factor"),
        R("uncertainty_carbon_emissions", 6).alias("uncertainty_carbon_emissions"))


# physical basis: quantity x factor per article, no currency
def physical_catalogue(spark, sf):
    p = B.table(spark, sf, "part")
    return p.groupBy(F.col("p_name").alias("article")).agg(
        (F.avg("p_retailprice") / F.lit(1000.0)).alias("kg_co2_eq"))


SQL_PHYSICAL = """physical AS (
  SELECT p_name AS article, avg(p_retailprice) / CAST(1000.0 AS DOUBLE) AS kg_co2_eq FROM part GROUP BY p_name)"""


@register("co2e_physical", B.with_sql(B.SQL_PURCHASES, SQL_PHYSICAL, """
SELECT l_orderkey, l_linenumber, p.article, round(quantity * kg_co2_eq, 6) AS co2e
FROM purchases p LEFT JOIN physical f ON f.article = p.article"""))
def co2e_physical(spark, sf):
    lines = B.purchases(spark, sf)
    x = report.attach_factors(lines, physical_catalogue(spark, sf), "article")
    return x.select("l_orderkey", "l_linenumber", "article",
                    R(money.co2e(F.col("quantity"), F.col("kg_co2_eq")), 6).alias("co2e"))


# J3 with a catalogue that repeats every code, once with its row and once without
# any value: one output row per line, with the factor (Q7)
@register("attach_factors", _with("""
SELECT l_orderkey, l_linenumber, cat_code, ef FROM lines2"""))
def attach_factors(spark, sf):
    cat = B.money_catalogue(spark, sf)
    doubled = cat.unionByName(cat.select("cat_code"), allowMissingColumns=True)
    x = report.attach_factors(B.purchases(spark, sf), doubled, "cat_code")
    return x.select("l_orderkey", "l_linenumber", "cat_code", "ef")


# ------------------------------------------------------------------ P1, P2, P3

@register("filter_entity", B.with_sql(B.SQL_PURCHASES, """
SELECT l_orderkey, l_linenumber, amount, currency FROM purchases WHERE entity = '1-URGENT'"""))
def filter_entity(spark, sf):
    return B.purchases(spark, sf).where(F.col("entity") == "1-URGENT").select(
        "l_orderkey", "l_linenumber", "amount", "currency")


CONFIDENTIAL = ["article", "segment", "supplier_name"]   # the last is absent: ignored


@register("drop_confidential", B.with_sql(B.SQL_PURCHASES, """
SELECT * EXCLUDE (article, segment) FROM purchases"""))
def drop_confidential(spark, sf):
    return relational.drop_columns(B.purchases(spark, sf), CONFIDENTIAL)


@register("final_projection", _with("""
SELECT l_orderkey, l_linenumber, article, category, cat_code, cat_description,
       round(amount_eur, 6) AS "Amount in EUR",
       round(amount_deflated, 6) AS "Amount in EUR corrected inflation in 1998",
       round(amount_usd, 6) AS "Amount in USD", round(co2e, 6) AS "CO2e" FROM lines2"""))
def final_projection(spark, sf):
    from ledgerlink.functions.cols import dedupe_names
    x = _lines(spark, sf)
    x = (x.withColumn("Amount in EUR", R("amount_eur", 6))
         .withColumn(f"Amount in EUR corrected inflation in {S.base_year}", R("amount_deflated", 6))
         .withColumn("Amount in USD", R("amount_usd", 6))
         .withColumn("CO2e", R("co2e", 6)))
    source_cols = ["l_orderkey", "l_linenumber", "article", "category", "cat_code"]
    target_keep = ["cat_code", "cat_description"]            # cat_code repeats: first wins (P4)
    computed = ["Amount in EUR", f"Amount in EUR corrected inflation in {S.base_year}",
                "Amount in USD", "CO2e"]
    from ledgerlink.functions.cols import c
    return x.select(*[c(n) for n in dedupe_names(source_cols + target_keep + computed)])


# ------------------------------------------------------------------ A7, A8, A9

@register("dash_article_category", _with("""
SELECT article, cat_description, round(sum(amount_eur), 2) AS total_price,
       round(sum(ef), 6) AS sum_factor, round(sum(co2e), 4) AS co2_kg
FROM lines2 GROUP BY article, cat_description"""))
def dash_article_category(spark, sf):
    return (_lines(spark, sf).groupBy("article", "cat_description")
            .agg(R(F.sum("amount_eur"), 2).alias("total_price"),
                 R(F.sum("ef"), 6).alias("sum_factor"),
                 R(F.sum("co2e"), 4).alias("co2_kg")))


@register("dash_sector", _with("""
SELECT segment AS sector, round(sum(co2e), 4) AS co2_kg, CAST(count(*) AS BIGINT) AS n_lines
FROM lines2 GROUP BY segment"""))
def dash_sector(spark, sf):
    return (_lines(spark, sf).groupBy(F.col("segment").alias("sector"))
            .agg(R(F.sum("co2e"), 4).alias("co2_kg"), F.count(F.lit(1)).alias("n_lines")))


@register("default_measures", _with("""
SELECT CAST(sum(l_orderkey) AS BIGINT) AS sum_l_orderkey, round(sum(amount), 2) AS sum_amount,
       round(sum(quantity), 2) AS sum_quantity, CAST(count(currency) AS BIGINT) AS cnt_currency,
       CAST(count(article) AS BIGINT) AS cnt_article, CAST(count(cat_description) AS BIGINT) AS cnt_cat_description,
       round(sum(co2e), 2) AS sum_co2e FROM lines2"""))
def default_measures(spark, sf):
    x = _lines(spark, sf).select("l_orderkey", "amount", "quantity", "currency", "article",
                                 "cat_description", "co2e")
    m = relational.default_measures(x)
    return m.select(F.col("sum_l_orderkey").cast("long").alias("sum_l_orderkey"),
                    R("sum_amount", 2).alias("sum_amount"),
                    R("sum_quantity", 2).alias("sum_quantity"),
                    "cnt_currency", "cnt_article", "cnt_cat_description",
                    R("sum_co2e", 2).alias("sum_co2e"))
