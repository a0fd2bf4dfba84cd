"""Money and emissions measures.

Rates and price indices are dimension tables keyed by month. When they are
built for a job period their size (months x currencies) is known from the
specification and they are broadcast without a measuring job; tables of
unknown size are broadcast only after a bounded count. The purchase side is
never shuffled for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink.functions.cols import c
from ledgerlink.functions.dates import month_start
from ledgerlink.session import bounded_broadcast

# Fallback rate of the reference for one currency with no
# published rate, valid towards EUR only.
FALLBACK_RATES = {("XOF", "EUR"): 0.00150}

RATE_TABLE_MAX_ROWS = 1_000_000   # months x currency pairs; far above any real table


def _small(df: DataFrame, known_max_rows: int | None) -> DataFrame:
    """Broadcast on a bound known from the job spec, else on a measured one."""
    if known_max_rows is not None and known_max_rows <= RATE_TABLE_MAX_ROWS:
        return F.broadcast(df)
    return bounded_broadcast(df, RATE_TABLE_MAX_ROWS)


def rate_lookup(rates: DataFrame, target: str, known_max_rows: int | None = None) -> DataFrame:
    """Rates towards ``target`` keyed by (month, currency), one row per key."""
    r = (rates.where(F.col("target") == target)
         .groupBy(F.col("month").alias("__fx_month"), F.col("currency").alias("__fx_cur"))
         .agg(F.min("rate").alias("__fx_rate")))
    return _small(r, known_max_rows)


def fx_rate_column(cur: Column, rate: Column, target: str) -> Column:
    """Same currency = 1; published rate; fallback; else null (quarantine)."""
    out = F.when(cur == target, F.lit(1.0)).when(rate.isNotNull(), rate)
    for (src, tgt), v in FALLBACK_RATES.items():
        if tgt == target:
            out = out.when(cur == src, F.lit(v))
    return out


def fx_convert(df: DataFrame, rates: DataFrame, date_col: str, cur_col: str, amount_col: str,
               target: str = "EUR", out_col: str | None = None,
               rate_col: str | None = None, known_max_rows: int | None = None) -> DataFrame:
    """``amount * rate(month, currency)``.

    Adds ``<rate_col>`` and ``<out_col>``; rows without any rate keep a null
    amount and ``fx_quarantined = true`` instead of failing the job.
    """
    out_col = out_col or f"Amount in {target}"
    rate_col = rate_col or f"rate_{target}"
    look = rate_lookup(rates, target, known_max_rows)
    x = df.withColumn("__fx_month", month_start(date_col)).withColumn("__fx_cur", c(cur_col))
    j = x.join(look, ["__fx_month", "__fx_cur"], "left")
    rate = fx_rate_column(c(cur_col), F.col("__fx_rate"), target)
    return (j.withColumn(rate_col, rate)
            .withColumn(out_col, c(amount_col) * c(rate_col))
            .withColumn("fx_quarantined", c(rate_col).isNull())
            .drop("__fx_month", "__fx_cur", "__fx_rate"))


def index_factors(index: DataFrame, base_year: int, known_max_rows: int | None = None) -> DataFrame:
    """Per month ``index(month) / index(base-year January)``.

    The base value is a scalar subquery over the index table (no action, no
    value pulled to the driver)."""
    base = index.where((F.year("month") == base_year) & (F.month("month") == 1)) \
        .select(F.max("index")).scalar()
    # one row per month, whatever the table repeats
    f = index.groupBy(F.col("month").alias("__ix_month")).agg((F.min("index") / base).alias("__ix_fac"))
    return _small(f, known_max_rows)


def price_index_range(index: DataFrame, a: Column, b: Column) -> DataFrame:
    """The index rows between two months, whichever comes first."""
    return index.where(F.col("month").between(F.least(a, b), F.greatest(a, b)))


def deflate(df: DataFrame, index: DataFrame, date_col: str, amount_col: str, base_year: int,
            out_col: str | None = None, known_max_rows: int | None = None) -> DataFrame:
    """``amount / (index(month) / index(base-year January))``. A line whose
    month has no index keeps a null amount and ``deflate_quarantined = true``."""
    out_col = out_col or f"{amount_col} corrected inflation in {base_year}"
    fac = index_factors(index, base_year, known_max_rows)
    x = df.withColumn("__ix_month", month_start(date_col)).join(fac, "__ix_month", "left")
    return (x.withColumn(out_col, c(amount_col) / F.col("__ix_fac"))
            .withColumn("deflate_quarantined", F.col("__ix_fac").isNull()).drop("__ix_month", "__ix_fac"))


def co2e(amount: Column, factor: Column) -> Column:
    """Emissions; null when amount or factor is null, 0 x f = 0."""
    return amount * factor


def total_uncertainty(attr: Column, pct80: Column, weight: float = 0.8) -> Column:
    """``attr + weight * pct80``."""
    return attr + F.lit(weight) * pct80


def optional_emissions(factor: Column, amount: Column) -> Column:
    """Emissions of a search answer; null without amount or factor."""
    return F.when(amount.isNotNull() & factor.isNotNull(), factor * amount)
