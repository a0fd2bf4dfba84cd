"""Registered queries: catalogue codes, prefix imputation, units, registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlink.functions.cols import round_half_away
from ledgerlink.operators import catalogue as CT
from ledgerlink.plans import bindings as B
from ledgerlink.plans.registry import register


def R(col, d):
    return round_half_away(F.col(col) if isinstance(col, str) else col, d)


VALUES = ["ef", "unc_attr", "unc_80"]
LEAF_LEN = 5


def codes_table(spark, sf):
    """Leaf codes (length 5, with factors) and all their prefixes (null factors)."""
    leaves = B.money_catalogue(spark, sf).select(F.col("cat_code").alias("code"), *VALUES)
    parents = CT.prefixes(leaves, "code").select(F.col("prefix").alias("code"),
                                                 *[F.lit(None).cast("double").alias(v) for v in VALUES])
    return leaves.unionByName(parents)


SQL_CODES = """codes AS (
  SELECT cat_code AS code, ef, unc_attr, unc_80 FROM catalogue
  UNION ALL
  SELECT DISTINCT substr(cat_code, 1, l), NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE
  FROM catalogue, range(1, 5) t(l))"""


@register("prefix_median_impute", B.with_sql(B.SQL_MONEY_CATALOGUE, SQL_CODES, """
ex AS (SELECT substr(code, 1, l) AS prefix, ef, unc_attr, unc_80
       FROM codes, range(1, 5) t(l) WHERE l < length(code)),
med AS (SELECT prefix, median(ef) AS m_ef, median(unc_attr) AS m_attr, median(unc_80) AS m_80
        FROM ex GROUP BY prefix)
SELECT code,
       round(CASE WHEN length(code) < 5 AND ef IS NULL THEN m_ef ELSE ef END, 9) AS ef,
       round(CASE WHEN length(code) < 5 AND unc_attr IS NULL THEN m_attr ELSE unc_attr END, 9) AS unc_attr,
       round(CASE WHEN length(code) < 5 AND unc_80 IS NULL THEN m_80 ELSE unc_80 END, 9) AS unc_80
FROM codes LEFT JOIN med ON med.prefix = codes.code"""))
def prefix_median_impute(spark, sf):
    """Parents take the median factor of their descendants."""
    out = CT.prefix_median_impute(codes_table(spark, sf), "code", VALUES, max_len=LEAF_LEN)
    return out.select("code", *[R(v, 9).alias(v) for v in VALUES])


@register("code_level_filter", B.with_sql(B.SQL_MONEY_CATALOGUE, SQL_CODES, """
SELECT code FROM codes WHERE length(code) < 4"""))
def code_level_filter(spark, sf):
    """The top levels (codes shorter than 4)."""
    return CT.code_level_filter(codes_table(spark, sf), "code", 4).select("code")


def _records(spark, sf):
    p = B.table(spark, sf, "part")
    unit = (F.when(F.col("p_type") == "SMALL", "g").when(F.col("p_type") == "MEDIUM", "kg")
            .when(F.col("p_type") == "LARGE", "t").when(F.col("p_type") == "ECONOMY", "Wh")
            .when(F.col("p_type") == "PROMO", "L"))
    return p.select("p_partkey", F.col("p_name").alias("Description"), unit.alias("unit"),
                    F.col("p_size").cast("double").alias("value"),
                    F.when(F.col("p_size") > 25, F.lit("Europe")).alias("Geographical_scope"))


SQL_UNITS = "units(unit, standard_unit, factor) AS (VALUES " + ", ".join(
    f"('{u}', '{s}', CAST({f!r} AS DOUBLE))" for u, s, f in CT.UNIT_FACTORS) + ")"


def _sql_default(f):
    d = CT.RECORD_DEFAULTS.get(f)
    return f"'{d}'" if d is not None else "NULL"


@register("standardize_units", B.with_sql(SQL_UNITS, f"""
rec AS (SELECT p_partkey, p_name AS Description,
               CASE p_type WHEN 'SMALL' THEN 'g' WHEN 'MEDIUM' THEN 'kg' WHEN 'LARGE' THEN 't'
                           WHEN 'ECONOMY' THEN 'Wh' WHEN 'PROMO' THEN 'L' END AS unit,
               CAST(p_size AS DOUBLE) AS value,
               CASE WHEN p_size > 25 THEN 'Europe' END AS Geographical_scope FROM part)
SELECT p_partkey, Description, {_sql_default('additional_context')} AS additional_context,
       coalesce(u.standard_unit, r.unit) AS unit, round(value * coalesce(u.factor, 1.0), 9) AS value,
       '{CT.RECORD_DEFAULTS['Allocation_method']}' AS Allocation_method,
       '{CT.RECORD_DEFAULTS['Market_transformation']}' AS Market_transformation,
       coalesce(Geographical_scope, '{CT.RECORD_DEFAULTS['Geographical_scope']}') AS Geographical_scope,
       '{CT.RECORD_DEFAULTS['Time_period']}' AS Time_period,
       '{CT.RECORD_DEFAULTS['System_boundary']}' AS System_boundary,
       NULL::VARCHAR AS Unit_measurement,
       '{CT.RECORD_DEFAULTS['Cutoff']}' AS Cutoff,
       '{CT.RECORD_DEFAULTS['Environmental_impact']}' AS Environmental_impact
FROM rec r LEFT JOIN units u ON u.unit = r.unit"""))
def standardize_units(spark, sf):
    """Product records with defaults and values in standard units."""
    out = CT.standardize_units(_records(spark, sf), CT.unit_table(spark))
    return out.withColumn("value", R("value", 9))


def registry(spark, sf):
    money = B.money_catalogue(spark, sf).withColumn("fu", F.lit("EUR"))
    agri = (B.table(spark, sf, "part").groupBy("p_name")
            .agg((F.avg("p_retailprice") / F.lit(1000.0)).alias("kg_co2_eq"))
            .select("p_name", F.upper(F.regexp_replace("p_name", " ", "_")).alias("code"), "kg_co2_eq",
                    F.lit("kg").alias("fu")))
    mobi = B.table(spark, sf, "nation").select(
        "n_name", "n_nationkey", ((F.col("n_regionkey") + 1) * F.lit(10.0)).alias("g"), F.lit("km").alias("fu"))
    uns = B.table(spark, sf, "region")
    return CT.catalogue_registry({
        "labo1point5": (money, CT.CatalogueRoles("cat_description", "cat_code", "ef", "kg CO2e", "fu")),
        "agribalyse": (agri, CT.CatalogueRoles("p_name", "code", "kg_co2_eq", "kg CO2e", "fu")),
        "mobitool": (mobi, CT.CatalogueRoles("n_name", "n_nationkey", "g", "g CO2e", "fu")),
        "unspsc": (uns, CT.CatalogueRoles("r_name", "r_regionkey", None, None, None)),
    })


@register("catalogue_registry", B.with_sql(B.SQL_MONEY_CATALOGUE, """
SELECT 'labo1point5' AS catalogue, cat_description AS category, cat_code AS code, round(ef, 9) AS factor,
       'kg CO2e' AS factor_unit, 'EUR' AS functional_unit FROM catalogue
UNION ALL
SELECT 'agribalyse', p_name, upper(replace(p_name, ' ', '_')), round(avg(p_retailprice) / CAST(1000.0 AS DOUBLE), 9),
       'kg CO2e', 'kg' FROM part GROUP BY p_name
UNION ALL
SELECT 'mobitool', n_name, CAST(n_nationkey AS VARCHAR), round((n_regionkey + 1) * CAST(10.0 AS DOUBLE), 9),
       'g CO2e', 'km' FROM nation
UNION ALL
SELECT 'unspsc', r_name, CAST(r_regionkey AS VARCHAR), NULL, NULL, NULL FROM region"""))
def catalogue_registry(spark, sf):
    """S3: four catalogues with their own column names as one table."""
    return registry(spark, sf).withColumn("factor", R("factor", 9))
