"""Documents to training tokens: toxic documents go, one document of each group of
near duplicates stays, documents with benchmark passages go, languages are mixed
to target weights, and what is left is written as token files.

Each stage works on what its predecessor kept. The stages that compare documents
decide on each row: they see a key of doc_id and text in place of the doc_id, so
rows without an id and rows that share one are told apart. Of a group of near
duplicates the row with the smallest id stays, once; a row without an id never
gives way to one that has an id, so of those one stays as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm import decontaminate, mixing, near_dup, token_file, toxicity
from ledgerlink.llm.common import broadcast_below, stage, table

DROP_BYTES = 64 << 20


def row_key(docs: DataFrame) -> Column:
    """MD5 of the text, then ':' and the doc_id where there is one: rows with
    equal keys have equal id and text."""
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    return F.concat(digest, F.coalesce(F.concat(F.lit(":"), F.col("doc_id").cast("string")), F.lit("")))


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(row_key(docs).alias("doc_id"), "text")


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose key is not among ``keys`` (distinct)."""
    keys = broadcast_below(stage(keys.select(F.col("key").alias("_key")), "dropped"), F.lit(80), DROP_BYTES)
    return docs.withColumn("_key", row_key(docs)).join(keys, "_key", "left_anti").select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = near_dup.near_duplicates(keyed(docs)).filter("n_shingles > 0")         # empty texts are nobody's copies
    rows = found.groupBy(F.col("doc_id").alias("key"), "component_id").agg(F.count(F.lit(1)).alias("n"))
    named = F.length("key") > 32
    rows = stage(rows.withColumn("named", named).withColumn("id", F.when(named, F.expr("substring(key, 34)")).cast(docs.schema["doc_id"].dataType)), "rows")
    first = rows.groupBy("component_id", "named").agg(F.min(F.struct("id", "key"))["key"].alias("first"))
    rows = stage(rows.join(first, ["component_id", "named"]).select("key", "n", (F.col("key") == F.col("first")).alias("stays")), "decided")
    again = rows.filter("stays and n > 1")
    if again.isEmpty():
        return without(docs, rows.filter("not stays"))
    # rows with equal id and text: one of them
    alone = without(docs, rows.filter("not stays or n > 1"))
    again = broadcast_below(again.select(F.col("key").alias("_key")), F.lit(80), DROP_BYTES)
    one = docs.withColumn("_key", row_key(docs)).join(again, "_key", "left_semi").dropDuplicates(["_key"])
    return alone.unionByName(one.select(*docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    items = items.withColumn("item_id", F.coalesce(F.col("item_id").cast("string"), F.lit("")))    # passages without an id count as well
    found = decontaminate.decontaminate(keyed(docs), items)
    return without(docs, found.filter("contaminated").select(F.col("doc_id").alias("key")).distinct())


def mix_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labelled = mixing.labelled_rows(docs, table(spark, sf_dir, "labels"), "lang")
    known = {r[0] for r in labelled.select("domain").distinct().collect()}       # a row per language
    targets = {k: v for k, v in mixing.TARGETS.items() if k in known}
    return mixing.mix_documents(docs, labelled, targets) if targets else docs


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_file.token_digest(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_languages),
    ("token_files", write_tokens),
]

#: The scores of the first stage come from a trained model, which SQL can not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
