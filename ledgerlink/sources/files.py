"""Scans and sinks.

Sources are read with an explicit schema (no inference pass over the data);
Parquet is the default, CSV / JSON / ORC go through the same call. Spreadsheet
containers are not read (no reader on the classpath): export sheets to CSV.
"""

from __future__ import annotations

import csv
import io

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.functions.cols import c, nan_to_null
from ledgerlink.session import materialize


def scan(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
         fmt: str = "parquet", **options) -> DataFrame:
    """Whole table with a user-supplied schema (column pruning and filter
    pushdown still apply to Parquet/ORC)."""
    r = spark.read.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def _after_line(line: str, inside: bool, sep: str) -> bool:
    """Whether a quoted field is open behind a line, if one is ``inside`` before it
    or not. A quote opens a field only as its first character, and two of them
    inside a field are one."""
    at = 0
    while True:
        if not inside and at < len(line) and line[at] == '"':
            inside, at = True, at + 1
        if inside:
            while True:
                at = line.find('"', at)
                if at < 0:
                    return True
                if line[at + 1:at + 2] != '"':
                    break
                at += 2
            inside = False
        at = line.find(sep, at)
        if at < 0:
            return False
        at += 1


def _split_runs(batches, *columns):
    """(file, split, rest of the row's columns as lists, whether it begins the split)
    of consecutive lines of one split."""
    last = None
    for pdf in batches:
        files, blocks = pdf["_f"].to_numpy(), pdf["_b"].to_numpy()
        edges = [0, *(np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1).tolist(), len(pdf)] if len(pdf) else []
        for a, b in zip(edges, edges[1:]):
            key = (files[a], int(blocks[a]))
            yield *key, [pdf[x].iloc[a:b].tolist() for x in columns], key != last
            last = key


def _quote_states(lines: DataFrame, skip: int, sep: str) -> DataFrame:
    """One row per split, stored: ``inside``, whether it begins inside a quoted
    field; ``owner``, the earlier split where the record open at its border began;
    ``ends_inside``.

    A split maps the state before it (outside or inside a quoted field) to the
    one behind it. It either keeps or flips the state, or sets it; so the state
    before a split is the value last set, flipped by the parity of the flips
    since: a running XOR over one row per split of the file."""
    def scan_splits(batches):
        f = b = None
        for f_, b_, (values,), new in _split_runs(batches, "value"):
            if new:
                if f is not None:
                    yield pd.DataFrame({"_f": [f], "_b": [b], "end0": [s[0]], "end1": [s[1]], "has0": [has[0]], "has1": [has[1]]})
                f, b, n, s, has = f_, b_, 0, [False, True], [False, False]
            for line in values:
                n += 1
                if b == 0 and n <= skip:
                    continue
                for i in (0, 1):
                    has[i] = has[i] or not s[i]
                    if '"' in line:
                        s[i] = _after_line(line, s[i], sep)
        if f is not None:
            yield pd.DataFrame({"_f": [f], "_b": [b], "end0": [s[0]], "end1": [s[1]], "has0": [has[0]], "has1": [has[1]]})

    ends = lines.select("value", "_f", "_b").mapInPandas(scan_splits, "_f string, _b long, end0 boolean, end1 boolean, has0 boolean, has1 boolean")
    flip, value = (~F.col("end1")).cast("int"), F.col("end0").cast("int")
    sets = F.col("end0") == F.col("end1")
    to_here = Window.partitionBy("_f").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("_f").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    x = ends.withColumn("_x", F.sum(F.when(sets, F.lit(0)).otherwise(flip)).over(to_here) % 2)
    x = x.withColumn("_set", F.when(sets, value.bitwiseXOR(F.col("_x").cast("int"))))
    x = x.withColumn("ends_inside", F.coalesce(F.last("_set", ignorenulls=True).over(to_here), F.lit(0)).bitwiseXOR(F.col("_x").cast("int")) == 1)
    x = x.withColumn("inside", F.coalesce(F.lag("ends_inside").over(Window.partitionBy("_f").orderBy("_b")), F.lit(False)))
    begins = F.when(F.when(F.col("inside"), F.col("has1")).otherwise(F.col("has0")), F.col("_b"))
    x = x.withColumn("owner", F.last(begins, ignorenulls=True).over(before))
    return materialize(x.select("_f", "_b", "inside", "ends_inside", "owner"), "csv-splits")


MOST_SPLITS = 1_000_000


def read_csv_records(spark: SparkSession, path: str, skip: int = 0, sep: str = ",") -> DataFrame:
    """(record, head) of CSV text files whose first ``skip`` lines are a preamble:
    each record as it stands, with the line ends inside its quoted fields, and
    whether it is the first of its file. Files are split like any text file.

    A first pass reduces each split to the quote state behind it, one row each
    (see ``_quote_states``). In the second, lines are joined to records inside
    their split; only the records that lie across a border are put together from
    their pieces by a shuffle. Lines of the preamble hold no fields and must lie in
    the file's first split. Empty records are dropped; a quote that is never
    closed takes the rest of its file."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_i"))
    splits = _quote_states(lines, skip, sep)
    few = splits.limit(MOST_SPLITS + 1).count() <= MOST_SPLITS

    def with_state(chosen: DataFrame) -> DataFrame:
        if few:                                          # a broadcast join leaves lines in their order
            return lines.join(F.broadcast(chosen), ["_f", "_b"])
        return lines.join(chosen, ["_f", "_b"]).repartition("_f", "_b").sortWithinPartitions("_f", "_b", "_i")

    def cut(batches):
        held: list[str] = []
        f = b = None
        for f_, b_, (values, insides, owners), new in _split_runs(batches, "value", "inside", "owner"):
            out = []
            if new:
                if held:
                    out.append((f, key, b, head, not inside, "\n".join(held)))
                f, b, n, held, inside, head = f_, b_, 0, [], bool(insides[0]), False
                key, lead, first = (int(owners[0]) if inside else b), inside, b == 0 and not inside
            for line in values:
                n += 1
                if b == 0 and n <= skip:
                    continue
                if held and not inside:
                    out.append((f, key, b, head, not lead, "\n".join(held)))
                    held, key, lead = [], b, False
                if not held and not lead:
                    head, first = first, False
                held.append(line)
                if '"' in line:
                    inside = _after_line(line, inside, sep)
            yield pd.DataFrame(out, columns=names)
        if held:
            yield pd.DataFrame([(f, key, b, head, not inside and not lead, "\n".join(held))], columns=names)

    names = ["_f", "_key", "_b", "head", "whole", "record"]
    schema = "_f string, _key long, _b long, head boolean, whole boolean, record string"
    columns = ["_f", "_b", "value", "inside", "owner"]
    whole = with_state(splits).select(*columns).mapInPandas(cut, schema).where("whole")
    over = splits.where("inside OR ends_inside")
    pieces = with_state(over).select(*columns).mapInPandas(cut, schema).where("NOT whole")
    joined = pieces.groupBy("_f", "_key").agg(F.sort_array(F.collect_list(F.struct("_b", "record"))).alias("_p"), F.max("head").alias("head"))
    joined = joined.select(F.array_join(F.col("_p.record"), "\n").alias("record"), "head")
    out = whole.select("record", "head").unionByName(joined)
    return out.select(F.regexp_replace("record", "\r$", "").alias("record"), "head").where(F.length("record") > 0)


def read_csv_skip_preamble(spark: SparkSession, path: str, skip: int, sep: str = ",") -> DataFrame:
    """CSV files whose first ``skip`` lines are a preamble, then a header.

    Records end at line ends outside quoted fields only (``read_csv_records``). The
    header names the columns; every column is text. Nothing is collected except
    one header record.
    """
    records = read_csv_records(spark, path, skip, sep)
    header = records.where("head").select("record").first()
    if header is None:
        return spark.createDataFrame([], T.StructType([]))
    names = [h.strip() for h in next(csv.reader(io.StringIO(header["record"], newline=""), delimiter=sep))]
    schema = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    body = records.where(~F.col("head"))
    parsed = body.select(F.from_csv("record", schema, {"sep": sep, "escape": '"', "multiLine": "true", "lineSep": "\n"}).alias("_r"))
    return parsed.select(*[F.col("_r")[n].alias(n) for n in names])


def write_csv_with_preamble(df: DataFrame, path: str, preamble: list[str], sep: str = ",") -> None:
    """Write ``df`` as CSV text files, each starting with ``preamble`` lines and
    a header (the layout of exported spreadsheets)."""
    cols = df.columns
    header = sep.join(cols)
    # quoted where a value holds the separator, a quote or a line end
    row = F.struct(*[c(x).cast("string").alias(x) for x in cols])
    lines = df.select(F.to_csv(row, {"sep": sep, "nullValue": "", "emptyValue": "", "escape": '"',
                                    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}).alias("value"))

    def with_preamble(batches):
        first = True
        for pdf in batches:
            if first:
                yield pd.DataFrame({"value": list(preamble) + [header]})
                first = False
            yield pdf

    lines.mapInPandas(with_preamble, "value string").write.mode("overwrite").text(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Flat files, no index; ``partition_by`` gives one folder per value
    (e.g. one per batch number)."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def typed_for_export(df: DataFrame) -> DataFrame:
    """Every column mapped to one of bigint, double, timestamp, boolean,
    string (the BI types); NaN becomes null."""
    out = []
    for f in df.schema.fields:
        t = f.dataType
        x = c(f.name)
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            out.append(x.cast("long").alias(f.name))
        elif isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
            out.append(nan_to_null(x.cast("double")).alias(f.name))
        elif isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out.append(x.cast("timestamp").alias(f.name))
        elif isinstance(t, T.BooleanType):
            out.append(x.alias(f.name))
        else:
            out.append(x.cast("string").alias(f.name))
    return df.select(*out)


def export_typed(df: DataFrame, path: str) -> None:
    """Create-or-replace a typed Parquet table."""
    write_table(typed_for_export(df), path, "parquet", "overwrite")


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, sort: bool = True,
                   path: str | None = None) -> DataFrame:
    """Save ``df`` as a table bucketed (and sorted) by ``key``.

    Two tables bucketed on their join key with the same bucket count join
    without a shuffle on either side (e.g. line items and orders on the order
    key, the largest join of the purchase binding). Returns the saved table.
    """
    w = df.write.mode("overwrite").format("parquet").bucketBy(buckets, key)
    if sort:
        w = w.sortBy(key)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
    return df.sparkSession.table(table)
