"""Registered queries: scans, sinks and the stage cache.

Queries that write do so under the session's checkpoint folder
(``spark.checkpoint.dir``), in a fresh sub-folder per call, then read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlink.operators import embed as EM
from ledgerlink.operators import relational as RL
from ledgerlink.operators import stages as ST
from ledgerlink.plans import bindings as B
from ledgerlink.plans.registry import register
from ledgerlink.session import scratch_path
from ledgerlink.sources import files as FS

LINEITEM_SCHEMA = ("l_orderkey long, l_linenumber int, l_quantity double, "
                   "l_extendedprice double, l_returnflag string")


@register("scan_source", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag FROM lineitem""")
def scan_source(spark, sf):
    """Whole table, explicit schema (a subset of the file's columns)."""
    return FS.scan(spark, f"{sf}/lineitem.parquet", LINEITEM_SCHEMA)


PREAMBLE = ["Catalogue export", "generated from the part table", ""]


@register("scan_skip_preamble", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_type, p_brand FROM part""")
def scan_skip_preamble(spark, sf):
    """CSV files with 3 preamble lines before the header, read back."""
    path = scratch_path(spark, "preamble-csv")
    part = B.table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    FS.write_csv_with_preamble(part, path, PREAMBLE)
    return FS.read_csv_skip_preamble(spark, path, skip=len(PREAMBLE))


@register("scan_quoted_records", """
SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role, nullif(text, '') AS text FROM conversations""")
def scan_quoted_records(spark, sf):
    """CSV files whose quoted fields hold line ends, read back by record."""
    path = scratch_path(spark, "quoted-csv")
    FS.write_csv_with_preamble(B.table(spark, sf, "conversations").select("conv_id", "turn", "role", "text"), path, PREAMBLE)
    return FS.read_csv_skip_preamble(spark, path, skip=len(PREAMBLE))


@register("sink_roundtrip", B.with_sql(B.SQL_PURCHASES, """
SELECT l_orderkey, l_linenumber, currency, cat_code, amount FROM purchases"""))
def sink_roundtrip(spark, sf):
    """Write the purchase lines as Parquet, read them back unchanged."""
    path = scratch_path(spark, "sink")
    lines = B.purchases(spark, sf).select("l_orderkey", "l_linenumber", "currency", "cat_code", "amount")
    FS.write_table(lines, path)
    return spark.read.parquet(path)


@register("typed_export", B.with_sql(B.SQL_PURCHASES, """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, ship_date,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE quantity END AS quantity,
       currency = 'EUR' AS in_target_currency, article FROM purchases"""))
def typed_export(spark, sf):
    """BI types (int -> bigint, NaN -> null, timestamp), replace, read back."""
    path = scratch_path(spark, "typed")
    p = B.purchases(spark, sf)
    x = p.select("l_orderkey", "l_linenumber", "ship_date",
                 F.when(F.col("l_linenumber") == 3, F.lit(float("nan"))).otherwise(F.col("quantity")).alias("quantity"),
                 (F.col("currency") == "EUR").alias("in_target_currency"), "article")
    FS.export_typed(x.limit(1), path)
    FS.export_typed(x, path)          # create-or-replace: a second export overwrites
    return spark.read.parquet(path)


BATCH_ROWS = B.SPEC.batch_rows


@register("batch_partitioned_sink", f"""
SELECT doc_id, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / {BATCH_ROWS}) AS BIGINT) AS batch_id
FROM documents""")
def batch_partitioned_sink(spark, sf):
    """One folder per batch number (``spec.batch_rows`` documents each), read back."""
    path = scratch_path(spark, "batches")
    b = RL.fixed_batches(B.table(spark, sf, "documents").select("doc_id"), ["doc_id"], BATCH_ROWS)
    FS.write_table(b.select("doc_id", "batch_id").repartition("batch_id"), path, partition_by=["batch_id"])
    back = spark.read.parquet(path)
    return back.select("doc_id", F.col("batch_id").cast("long").alias("batch_id"))


MODEL = "char-profile-v1"


def _profile_text(col):
    return F.array_join(F.transform(col, lambda x: x.cast("long").cast("string")), ",")


@register("embedding_cache_merge", """
WITH t AS (SELECT p_name AS text FROM part UNION SELECT p_type FROM part)
SELECT text, text IN (SELECT p_type FROM part) AS from_cache,
       array_to_string(list_transform(
         [""" + ", ".join(f"length(lower(text)) - length(replace(lower(text), '{ch}', ''))"
                          for ch in "abcdefghijklmnopqrstuvwxyz0123456789") + """],
         lambda x: CAST(x AS VARCHAR)), ',') AS embedding FROM t""")
def embedding_cache_merge(spark, sf):
    """A stage cache seeded with the category texts, twice (the second commit
    finds the first); merging all article and category texts embeds only the
    articles and reuses the rest. The merged result is a stage of its own, keyed
    by its input's fingerprint, and is read back by the second call."""
    path = scratch_path(spark, "embed-cache")
    part = B.table(spark, sf, "part")
    seed = part.select(F.col("p_type").alias("text")).distinct()
    for _ in range(2):
        EM.write_cache(EM.char_profile_vectors(seed), path, MODEL)
    texts = part.select(F.col("p_name").alias("text")).union(part.select("p_type")).distinct()
    stages = ST.StageStore(spark, scratch_path(spark, "stages"))
    for _ in range(2):
        merged = stages.reuse("merged", [texts], lambda t: EM.merge_with_cache(t, path, MODEL, EM.char_profile_vectors)[0], "1", {"model": MODEL})
    return merged.select("text", "from_cache", _profile_text(F.col("embedding")).alias("embedding"))
