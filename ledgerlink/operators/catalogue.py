"""Catalogue preparation.

Prefix imputation (J11). A parent code without a factor takes the median of
the factors of all longer codes that start with it. The direct formulation
(``startswith`` + ``length``) is a nested-loop join, O(n²). Instead every code
with a value is exploded into its proper prefixes (O(n x code length) rows) and
the medians are taken per prefix with ``exact_median_by``, which is skew-proof
(a one-letter prefix may hold a third of all codes). Medians use *original*
values only, so the result does not depend on row order (Q10).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.functions.cols import c, float_fields
from ledgerlink.operators.relational import exact_median_by
from ledgerlink.session import bounded_broadcast


# ------------------------------------------------------------------ J11, P8

def prefixes(codes: DataFrame, code_col: str, min_len: int = 1) -> DataFrame:
    """Every proper prefix (length ``min_len`` .. len-1) of every code."""
    x = codes.where(F.length(c(code_col)) > min_len).select(
        c(code_col).alias("_code"), F.explode(F.sequence(F.lit(min_len), F.length(c(code_col)) - 1)).alias("_l"))
    return x.select(F.col("_code").substr(F.lit(1), F.col("_l")).alias("prefix")).distinct()


def prefix_median_impute(codes: DataFrame, code_col: str, value_cols: list[str] | None = None,
                         max_len: int = 5) -> DataFrame:
    """Fill null ``value_cols`` of codes shorter than ``max_len`` with the median
    of the non-null values of their longer descendants. Without ``value_cols``
    every floating-point column is imputed (P18)."""
    value_cols = value_cols or float_fields(codes)
    ex = codes.where(F.length(c(code_col)) > 1).select(
        c(code_col).alias("_code"), *[c(v) for v in value_cols],
        F.explode(F.sequence(F.lit(1), F.length(c(code_col)) - 1)).alias("_l"))
    # long form (value name, prefix, value): one global ordering for all columns
    long = ex.select(F.col("_code").substr(F.lit(1), F.col("_l")).alias("_prefix"),
                     F.explode(F.array(*[F.struct(F.lit(v).alias("_name"), c(v).cast("double").alias("_val"))
                                         for v in value_cols])).alias("_nv"))
    long = long.select("_prefix", "_nv._name", "_nv._val")
    med = exact_median_by(long, ["_name", "_prefix"], "_val", name="_med")
    wide = med.groupBy(F.col("_prefix").alias("_p")).agg(
        *[F.max(F.when(F.col("_name") == v, F.col("_med"))).alias(f"_med_{v}") for v in value_cols])
    out = codes.join(wide, codes[code_col] == wide["_p"], "left").drop("_p")
    for v in value_cols:
        fill = (F.length(c(code_col)) < max_len) & c(v).isNull()
        out = out.withColumn(v, F.when(fill, F.col(f"_med_{v}")).otherwise(c(v))).drop(f"_med_{v}")
    return out


def code_level_filter(codes: DataFrame, code_col: str, max_len: int) -> DataFrame:
    """Codes shorter than ``max_len`` (the top levels of the hierarchy)."""
    return codes.where(F.length(c(code_col)) < max_len)


# ------------------------------------------------------------------ M10

# Standard units of the product record and the conversion
# factors to them.
UNIT_FACTORS = [
    ("mg", "kg", 1e-6), ("g", "kg", 0.001), ("kg", "kg", 1.0), ("t", "kg", 1000.0),
    ("ml", "m3", 1e-6), ("l", "m3", 0.001), ("L", "m3", 0.001), ("m3", "m3", 1.0),
    ("Wh", "kWh", 0.001), ("kWh", "kWh", 1.0), ("MWh", "kWh", 1000.0),
    ("kJ", "MJ", 0.001), ("MJ", "MJ", 1.0), ("GJ", "MJ", 1000.0),
    ("cm", "m", 0.01), ("m", "m", 1.0), ("km", "m", 1000.0), ("m2", "m2", 1.0),
    ("min", "hours", 1.0 / 60.0), ("h", "hours", 1.0), ("hours", "hours", 1.0), ("year", "year", 1.0),
]

# Defaults of the product record fields.
RECORD_DEFAULTS = {
    "additional_context": "",
    "Allocation_method": "No allocation",
    "Market_transformation": "Market",
    "Geographical_scope": "Global",
    "Time_period": "2024",
    "System_boundary": "Cradle to grave",
    "Cutoff": "Cumulative cutoff",
    "Environmental_impact": "Global warming potential",
}
RECORD_FIELDS = ["Description", "additional_context", "unit", "value", "Allocation_method",
                 "Market_transformation", "Geographical_scope", "Time_period", "System_boundary",
                 "Unit_measurement", "Cutoff", "Environmental_impact"]


def unit_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(UNIT_FACTORS, "unit string, standard_unit string, factor double")


def standardize_units(records: DataFrame, units: DataFrame) -> DataFrame:
    """A 12-field product record; missing fields take their defaults and
    the value is converted to the standard unit (unknown units pass as is)."""
    u = bounded_broadcast(units.select(F.col("unit").alias("_u"), "standard_unit", "factor"), 100_000)
    x = records
    for f in RECORD_FIELDS:
        if f not in x.columns:
            x = x.withColumn(f, F.lit(None).cast("double" if f == "value" else "string"))
    x = x.join(u, x["unit"] == u["_u"], "left")
    out = [
        c("Description"),
        *[F.coalesce(c(f), F.lit(d)).alias(f) if (d := RECORD_DEFAULTS.get(f)) is not None else c(f)
          for f in ["additional_context"]],
        F.coalesce(F.col("standard_unit"), c("unit")).alias("unit"),
        (c("value").cast("double") * F.coalesce(F.col("factor"), F.lit(1.0))).alias("value"),
        *[F.coalesce(c(f), F.lit(RECORD_DEFAULTS[f])).alias(f) if f in RECORD_DEFAULTS else c(f)
          for f in RECORD_FIELDS[4:]],
    ]
    keep = [x for x in records.columns if x not in RECORD_FIELDS]
    return x.select(*[c(k) for k in keep], *out)


# ------------------------------------------------------------------ S3

@dataclass(frozen=True)
class CatalogueRoles:
    """Column roles of one search catalogue (None = the catalogue lacks it)."""
    category: str
    code: str
    factor: str | None
    factor_unit: str | None
    functional_unit: str | None


def catalogue_registry(catalogues: dict[str, tuple[DataFrame, CatalogueRoles]]) -> DataFrame:
    """S3: one table of all catalogues, roles renamed, a ``catalogue`` column."""
    parts = []
    for name, (df, r) in catalogues.items():
        parts.append(df.select(
            F.lit(name).alias("catalogue"),
            c(r.category).cast("string").alias("category"),
            c(r.code).cast("string").alias("code"),
            (c(r.factor).cast("double") if r.factor else F.lit(None).cast("double")).alias("factor"),
            (F.lit(r.factor_unit) if r.factor_unit else F.lit(None).cast("string")).alias("factor_unit"),
            (c(r.functional_unit).cast("string") if r.functional_unit else F.lit(None).cast("string"))
            .alias("functional_unit")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def select_catalogue(registry: DataFrame, name: str, valid: list[str]) -> DataFrame:
    """Rows of one catalogue; an unknown name is an error listing valid ones."""
    if name not in valid:
        raise ValueError(f"no catalogue is called {name!r}; known ones: {', '.join(valid)}")
    return registry.where(F.col("catalogue") == name)


def split_requests(requests: DataFrame, name_col: str, registry: DataFrame,
                   registry_col: str = "catalogue") -> tuple[DataFrame, DataFrame]:
    """J14/S3 in batch form: (requests naming a known catalogue, the others
    with an ``error`` text listing the valid names). A bad request no longer
    fails the batch; the list of names is one aggregated row (bounded by the
    number of catalogues), attached without a join via a scalar subquery."""
    names = registry.select(F.col(registry_col).alias("_n")).distinct()
    valid = requests.join(names, requests[name_col] == names["_n"], "left_semi")
    invalid = requests.join(names, requests[name_col] == names["_n"], "left_anti")
    listing = names.select(F.array_join(F.sort_array(F.collect_list("_n")), ", ")).scalar()
    err = F.concat(F.lit("no catalogue is called '"), c(name_col), F.lit("'; known ones: "), listing)
    return valid, invalid.withColumn("error", err)
