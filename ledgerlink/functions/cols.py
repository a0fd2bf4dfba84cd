"""Column-name and null-policy helpers.

Catalogue and result column names carry dots and blanks
(``per1p5.ef.kg.co2e.per.euro``, ``Amount in EUR``); ``c()`` back-ticks them so
Spark never reads the dot as a struct access.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def c(name: str) -> Column:
    """Column by its literal name (dots and blanks allowed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def nan_to_null(col: Column) -> Column:
    """NaN becomes null, so ``avg``/``sum`` skip it as pandas does."""
    return F.when(F.isnan(col), F.lit(None)).otherwise(col)


def dedupe_names(names: list[str]) -> list[str]:
    """Keep the first occurrence of every column name, in order."""
    seen, out = set(), []
    for n in names:
        if n not in seen:
            seen.add(n)
            out.append(n)
    return out


def existing(df: DataFrame, names: list[str]) -> list[str]:
    cols = set(df.columns)
    return [n for n in names if n in cols]


def numeric_fields(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                                       T.FloatType, T.DoubleType, T.DecimalType))]


def float_fields(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]


def string_fields(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def round_half_away(col: Column, digits: int) -> Column:
    """Round the *binary* value ``col * 10^digits`` half away from zero.

    Spark's ``round`` rounds the shortest decimal string of a double, so a value
    printed as ``...5`` always goes up, while ``x * 10^d`` may fall just below the
    tie in binary. This form performs the same double operations as common SQL
    engines (DuckDB, C ``round``), so results agree bit for bit.
    """
    m = F.lit(float(10 ** digits))
    return F.round(col * m, 0) / m
