"""Column profiling and role inference.

The reference shows a 5-row head to a language model and asks which column is
the date, amount, unit, description and context. Here every column is
profiled in one distributed pass over the *whole* table (long form: one row
per (column, value), grouped by column, combined map-side), and roles are
chosen from the profile by fixed rules. Roles left empty come back as rows
with a null column (they are reported, not only logged).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlink.functions import text as TX
from ledgerlink.functions.cols import c

# date formats recognised by the profiler (strict patterns, not free casts),
# each with the shape a value must have before it is handed to the parser
DATE_FORMATS = {"yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}$", "dd/MM/yyyy": r"^\d{2}/\d{2}/\d{4}$"}
# plain decimal numbers (optionally signed, with exponent)
NUMBER_SHAPE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

ROLES = ["date_column", "amount_column", "unit_column", "description_column", "contextual_column"]


def profile_columns(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per column: non-null and distinct counts, share of values castable to a
    date and to a number, mean length and mean word count of the text form."""
    cols = cols or df.columns
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("column"), c(n).cast("string").alias("value")) for n in cols])).alias("kv")
    ).select("kv.column", "kv.value")
    # one row per distinct (column, value) with its multiplicity, combined
    # map-side: each feature below is computed once per distinct value and
    # weighted by its count (categorical columns collapse to a few rows)
    pv = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_w"))
    v = F.col("value")
    w = F.col("_w")
    nn = v.isNotNull()
    # cheap shape tests first: the parsers only see plausible values (a failed
    # parse is far more expensive than a regex test)
    is_date = F.coalesce(*[F.when(v.rlike(shape), F.try_to_date(v, fmt))
                           for fmt, shape in DATE_FORMATS.items()]).isNotNull()
    is_number = F.when(v.rlike(NUMBER_SHAPE), v.try_cast("double")).isNotNull()
    weighted = lambda cond: F.sum(F.when(nn & cond, w).otherwise(0))
    g = pv.groupBy("column").agg(
        F.sum(F.when(nn, w).otherwise(0)).alias("n_nonnull"),
        F.count("value").alias("n_distinct"),
        weighted(is_date).alias("_nd"),
        weighted(is_number).alias("_nx"),
        (F.sum(F.when(nn, w * F.length(v))) / F.sum(F.when(nn, w))).alias("avg_len"),
        (F.sum(F.when(nn, w * TX.word_count(v))) / F.sum(F.when(nn, w))).alias("avg_words"))
    share = lambda x: F.when(F.col("n_nonnull") > 0, F.col(x) / F.col("n_nonnull")).otherwise(F.lit(0.0))
    return g.select("column", F.col("n_nonnull").cast("long").alias("n_nonnull"),
                    F.col("n_distinct").cast("long").alias("n_distinct"),
                    share("_nd").alias("date_share"), share("_nx").alias("number_share"),
                    "avg_len", "avg_words")


def infer_roles(profile: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """One row per role: the best column by rule, or null.

    date         date_share >= 0.9, highest share
    amount       number_share >= 0.9 and not the date, most distinct values
    unit         short text (avg_len <= 4, < 0.5 numeric), fewest distinct values
    description  text with the most words on average (>= 1.5)
    contextual   the next text column by distinct values, other than the above
    """
    p = profile.where(~F.col("column").isin(*(exclude or [])))
    text = (F.col("number_share") < 0.5) & (F.col("date_share") < 0.5)

    def best(cond, order):
        # the smallest (order, name) of the columns that qualify
        return F.min(F.when(cond, F.struct(order.alias("o"), F.col("column").alias("column"))))["column"]

    # one pass over the profile, one row
    picked = p.agg(
        best(F.col("date_share") >= 0.9, -F.col("date_share")).alias("date_column"),
        best((F.col("number_share") >= 0.9) & (F.col("date_share") < 0.9), -F.col("n_distinct")).alias("amount_column"),
        best(text & (F.col("avg_len") <= 4), F.col("n_distinct")).alias("unit_column"),
        best(text & (F.col("avg_words") >= 1.5), -F.col("avg_words")).alias("description_column"),
        best(text & (F.col("avg_len") > 4) & (F.col("avg_words") < 1.5), -F.col("n_distinct")).alias("contextual_column"))
    return picked.select(F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.col(r).alias("column")) for r in ROLES])).alias("r")).select("r.*")


def roles_complete(roles: DataFrame) -> DataFrame:
    """One row, ``complete`` = every role has a column (``every``)."""
    return roles.agg(F.every(F.col("column").isNotNull()).alias("complete"),
                     F.sum(F.when(F.col("column").isNull(), 1).otherwise(0)).cast("long").alias("n_missing"))


def fill_roles(configured: dict, roles: DataFrame) -> dict:
    """P20: roles left empty in the job settings take the inferred column.
    ``roles`` has one row per role (five rows), so collecting it is bounded."""
    inferred = {r["role"]: r["column"] for r in roles.collect()}
    out = dict(configured)
    for role, col in inferred.items():
        if not out.get(role):
            out[role] = col
    return out
