"""JSON in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Shape of a chooser answer: {"<row>": {"ID": <long>, "Chosen option": <text>}}
CHOICE_SCHEMA = "map<string, struct<ID: bigint, `Chosen option`: string>>"
# Shape of a rating answer: {"<row>": {"Semantic match": <int>}}
# Shape of cluster titles: [{"id": int, "title": text, "description": text}]
TITLES_SCHEMA = "array<struct<id: int, title: string, description: string>>"


def rows_to_json(cols: list) -> Column:
    """one JSON record per row."""
    return F.to_json(F.struct(*cols))


def parse_json(col: Column, schema: str, single_quotes: bool = False) -> Column:
    """parse permissively; malformed text gives null (count those)."""
    opts = {"mode": "PERMISSIVE"}
    if single_quotes:
        opts["allowSingleQuotes"] = "true"
    return F.from_json(col, schema, opts)


def explode_answers(df: DataFrame, answer_col: str, schema: str, keep: list[str]) -> DataFrame:
    """A keyed JSON answer map to one row per (row key, answer)."""
    parsed = df.select(*keep, parse_json(F.col(answer_col), schema).alias("_m"))
    return parsed.select(*keep, F.explode_outer("_m").alias("row_key", "answer"))
