"""The end-to-end emissions job (M14) and the dashboard measures.

Plan shape of ``emissions_summary`` (the flagship):

  purchase lines ──(partial+final aggregate by code, month, currency)──┐
                                                                      ├─ tiny
  rates, price index (broadcast, bound = months x currencies) ────────┤  joins
  catalogue (broadcast after a bounded count)  ───────────────────────┘
                 └─ final aggregate by the report dimensions

Rates, deflators and factors are constant within (code, month, currency), so
the sums of amounts are taken *before* those joins (eager aggregation): the
only wide operations on the purchase lines are the scans, their joins, and one
partially-aggregated shuffle, whose output has at most codes x months x
currencies rows whatever the number of lines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink.functions import text as TX
from ledgerlink.functions.cols import c, round_half_away
from ledgerlink.functions.dates import month_start
from ledgerlink.operators import matching, money, relational
from ledgerlink.session import bounded_broadcast, materialize
from ledgerlink.spec import JobSpec

CATALOGUE_BROADCAST_MAX_ROWS = 2_000_000


def attach_factors(lines: DataFrame, catalogue: DataFrame, key: str, cat_key: str | None = None,
                   max_rows: int = CATALOGUE_BROADCAST_MAX_ROWS, check_size: bool = True) -> DataFrame:
    """Left join lines to the catalogue on its id.

    The catalogue is made unique by id first (lowest row wins, nulls last), so a
    repeated catalogue row can never fan out the purchase lines (Q7). ``check_size=False``
    leaves the strategy to the planner/AQE (for joins whose other side is
    already small, e.g. after pre-aggregation)."""
    cat_key = cat_key or key
    others = [x for x in catalogue.columns if x != cat_key]
    uniq = (catalogue.groupBy(c(cat_key)).agg(F.min(F.struct(*[x for o in others for x in (c(o).isNull().alias(f"_null_{o}"), c(o))])).alias("_r"))
            .select(c(cat_key).alias(key), *[F.col("_r")[o].alias(o) for o in others]))
    return lines.join(bounded_broadcast(uniq, max_rows) if check_size else uniq, key, "left")


def emissions_summary(lines: DataFrame, rates: DataFrame, index: DataFrame, catalogue: DataFrame,
                      spec: JobSpec, code_col: str, date_col: str, cur_col: str, amount_col: str,
                      dims: list[str], rates_rows: int | None = None) -> DataFrame:
    """Amounts converted, deflated, multiplied by factors, summed by ``dims``.

    ``dims`` may name line columns and ``year`` (of the line's month). Without
    rates (Q12) amounts count as converted, without an index as deflated, and on
    the physical basis (Q20) the amount is a quantity: neither applies.
    """
    physical = spec.basis == "physical"
    line_dims = [d for d in dims if d != "year"]
    pre = (lines.withColumn("_month", month_start(date_col))
           .groupBy(c(code_col), "_month", c(cur_col), *[c(d) for d in line_dims if d not in (code_col, cur_col)])
           .agg(F.sum(c(amount_col)).alias("_amount"), F.count(F.lit(1)).alias("_n")))
    if physical or rates is None:
        conv = pre.withColumn("_amount_eur", F.col("_amount")).withColumn("fx_quarantined", F.lit(False))
    else:
        conv = money.fx_convert(pre, rates, "_month", cur_col, "_amount", spec.target_currency,
                                out_col="_amount_eur", rate_col="_rate", known_max_rows=rates_rows)
    if physical or index is None:
        defl = conv.withColumn("_amount_defl", F.col("_amount_eur"))
    else:
        defl = money.deflate(conv, index, "_month", "_amount_eur", spec.base_year,
                             out_col="_amount_defl", known_max_rows=rates_rows)
    # both sides are small here (codes x months x currencies vs the catalogue)
    fac = attach_factors(defl, catalogue, code_col, check_size=False)
    emis = money.co2e(F.col("_amount_defl"), F.col("ef"))
    unc = emis * money.total_uncertainty(F.col("unc_attr"), F.col("unc_80"), spec.pct80_weight)
    out = (fac.withColumn("year", F.year("_month").cast("long"))
           .groupBy(*[c(d) for d in dims])
           .agg(F.sum("_n").cast("long").alias("n_lines"),
                F.sum(F.when(F.col("fx_quarantined"), F.col("_n")).otherwise(0)).cast("long").alias("n_quarantined"),
                round_half_away(F.sum("_amount_eur"), 2).alias("amount_eur"),
                round_half_away(F.sum("_amount_defl"), 2).alias("amount_deflated"),
                round_half_away(F.sum(emis), 2).alias("co2e_kg"),
                round_half_away(F.sum(unc), 2).alias("uncertainty_kg")))
    return out


def emissions_lines(lines: DataFrame, rates: DataFrame, index: DataFrame, catalogue: DataFrame,
                    spec: JobSpec, code_col: str, date_col: str, cur_col: str, amount_col: str,
                    rates_rows: int | None = None) -> DataFrame:
    """Line-level result table (D1-D7): amounts in the target and second
    currency, deflated amount, factor columns, emissions and uncertainty.

    With ``spec.basis == 'physical'`` (Q20) the amount is a physical quantity:
    no currency conversion or deflation, emissions = amount x factor (D4)."""
    if spec.basis == "physical":
        x = attach_factors(lines, catalogue, code_col)
        x = x.withColumn("co2e", money.co2e(c(amount_col), F.col("ef")))
        x = x.withColumn("total_uncertainty_factor",
                         money.total_uncertainty(F.col("unc_attr"), F.col("unc_80"), spec.pct80_weight))
        return x.withColumn("uncertainty_carbon_emissions", F.col("co2e") * F.col("total_uncertainty_factor"))
    t = spec.target_currency
    if rates is None:
        # Q12: no rate table configured: amounts are taken as already converted
        x = (lines.withColumn("rate_eur", F.lit(1.0)).withColumn("amount_eur", c(amount_col))
             .withColumn("rate_usd", F.lit(None).cast("double"))
             .withColumn("amount_usd", F.lit(None).cast("double")))
    else:
        x = money.fx_convert(lines, rates, date_col, cur_col, amount_col, t,
                             out_col="amount_eur", rate_col="rate_eur", known_max_rows=rates_rows)
        x = money.fx_convert(x.drop("fx_quarantined"), rates, date_col, cur_col, amount_col,
                             spec.second_currency, out_col="amount_usd", rate_col="rate_usd",
                             known_max_rows=rates_rows).drop("fx_quarantined")
    x = x.withColumn("fx_quarantined", F.col("rate_eur").isNull())
    if index is None:
        # Q12: no price index configured: amounts are not deflated
        x = x.withColumn("amount_deflated", F.col("amount_eur"))
    else:
        x = money.deflate(x, index, date_col, "amount_eur", spec.base_year,
                          out_col="amount_deflated", known_max_rows=rates_rows)
    x = attach_factors(x, catalogue, code_col)
    x = x.withColumn("co2e", money.co2e(F.col("amount_deflated"), F.col("ef")))
    x = x.withColumn("total_uncertainty_factor",
                     money.total_uncertainty(F.col("unc_attr"), F.col("unc_80"), spec.pct80_weight))
    return x.withColumn("uncertainty_carbon_emissions", F.col("co2e") * F.col("total_uncertainty_factor"))


def full_job(lines: DataFrame, catalogue: DataFrame, corrections: DataFrame | None, rates: DataFrame | None, index: DataFrame | None,
             spec: JobSpec, article: str, category: str, code: str, description: str, date_col: str, cur_col: str, amount_col: str,
             embed: Callable[[Column], Column], rates_rows: int | None = None) -> DataFrame:
    """M14 from raw lines: distinct rows (A1), no empty ones (P6), corrections (J1),
    digits off the article (F4), most specific level and category as text (P9),
    match against the prepared catalogue (M13), amounts and emissions (D1-D7),
    rating and flag of the match (M7).

    The cleaned lines and the catalogue are stored once: the match reads both
    several times. Without a price index or rates, and on the physical basis, the
    amounts follow ``emissions_lines``.
    """
    x = relational.dropna_all(relational.distinct_rows(lines), [article, category])
    if corrections is not None:
        x = relational.apply_corrections(x, corrections, article)
    level = TX.hierarchical_select([c(category), TX.strip_digits(c(article))])
    x = materialize(x.withColumn("match_text", TX.combine_columns([level, F.lower(c(category))])), "job-lines")
    cat = catalogue.withColumn(description, TX.rstrip_unicode(c(description)))
    cat = materialize(relational.distinct_keep_first(cat, [description], code), "job-catalogue")
    m = matching.match_pipeline(x, "match_text", cat, code, description, embed, spec.top_n, spec.w_cosine, spec.w_overlap,
                                spec.w_breadth, min_score=spec.min_score)
    m = emissions_lines(m.withColumnRenamed("match_id", code), rates, index, cat, spec, code, date_col, cur_col, amount_col, rates_rows)
    return matching.flag_mismatches(m, "match_similarity")
