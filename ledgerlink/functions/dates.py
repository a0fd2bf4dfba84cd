"""Date expressions (F13-F15). ANSI mode is on in Spark 4, so parsing uses
``try_to_date``: a malformed or impossible date becomes null (and is counted or
quarantined by the caller) instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlink.functions.cols import c


def _as_col(x) -> Column:
    return c(x) if isinstance(x, str) else x


def parse_date(col, fmt: str = "dd/MM/yyyy") -> Column:
    """text in ``fmt`` to a date; dates and timestamps pass through."""
    x = _as_col(col)
    # the type is known when the plan is analysed: only one branch remains
    return F.when(F.typeof(x).isin("date", "timestamp", "timestamp_ntz"), x.cast("string").substr(1, 10).try_cast("date")) \
            .otherwise(F.try_to_date(x.cast("string"), fmt))


def month_start(col) -> Column:
    """first day of the month of a date or timestamp."""
    return F.trunc(F.to_date(_as_col(col)), "MM")


def month_text(col) -> Column:
    """``yyyy-MM``."""
    return F.date_format(_as_col(col), "yyyy-MM")
