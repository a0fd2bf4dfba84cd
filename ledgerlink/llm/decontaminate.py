"""Benchmark decontamination by winnowed k-gram fingerprints.

Words are runs of a-z, 0-9 and non-ASCII characters after lower-casing A-Z. An
item's windows are its runs of ``WINDOW`` consecutive words, or all its words if
it has fewer. A document word is hit if it lies inside an occurrence of a window.

1. Winnowing: of every ``WINDOW - K + 1`` consecutive K-gram hashes the smallest
   is kept, for items and documents alike. A shared run of WINDOW words holds the
   same K-grams on both sides and therefore the same smallest one: no shared
   window is missed. (Items of L < WINDOW words use min(K, L)-grams and windows
   of L words, for each such L that occurs.)
2. Documents' fingerprints are joined with those of the items.
3. Extension: each hit fingerprint of a document is looked up in its K-grams
   again, and the windows around these places are compared, as text, with the
   items' windows. What is equal is a hit; its words are counted once.

All of it is DataFrame functions. Pass 1 reads the documents without moving
their text; only documents with a hit fingerprint are read again. Items are
broadcast where their measured size allows, otherwise joined by shuffle.

The items that have a window in common are named by one key, so a passage that
all items share adds one row for each of its places, not one for each item.

Defined cases: null and empty texts have no words and are clean; an item without
words is ignored; rows that repeat an item id are one item, and so are those
without an id: it counts in n_hit, n_items and contaminated but has no name to hash;
repeated documents stay, each with its result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm.common import Stages, ascii_lower, broadcast_below, table

WINDOW = 10
K = 5
BROADCAST_BYTES = 64 << 20


def words(text: Column) -> Column:
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1)
    return F.filter(parts, lambda w: w != "")


def gram_hashes(codes: str, k: int) -> Column:
    """Hashes of k consecutive entries of the long array column ``codes``."""
    c = F.col(codes)
    return F.when(F.size(c) >= k, F.transform(F.sequence(F.lit(0), F.size(c) - k), lambda i: F.xxhash64(*[F.get(c, i + j) for j in range(k)]))
                  ).otherwise(F.array().cast("array<bigint>"))


def winnow(grams: str, window: int) -> Column:
    """The smallest of every ``window`` consecutive entries, each value once."""
    g = F.col(grams)
    if window == 1:
        return F.array_distinct(g)
    smallest = F.transform(F.sequence(F.lit(0), F.size(g) - window), lambda i: F.least(*[F.get(g, i + j) for j in range(window)]))
    return F.when(F.size(g) >= window, F.array_distinct(smallest)).otherwise(F.array().cast("array<bigint>"))


def shape(length: int) -> tuple[int, int]:
    """(k, window in k-grams) that finds every shared run of ``length`` words."""
    k = min(K, length)
    return k, length - k + 1


def with_grams(df: DataFrame, lengths: list[int]) -> DataFrame:
    """Adds ``codes`` and, per k needed, ``g<k>`` to rows with ``ws``."""
    df = df.withColumn("codes", F.transform("ws", lambda w: F.xxhash64(w)))
    for k in sorted({shape(n)[0] for n in lengths}):
        df = df.withColumn(f"g{k}", gram_hashes("codes", k))
    return df


def window_starts(length: int) -> Column:
    """Starts of the runs of ``length`` words around the K-grams in ``marks``."""
    k, window = shape(length)
    g, last = F.col(f"g{k}"), F.size("ws") - length
    places = F.filter(F.sequence(F.lit(0), F.size(g) - 1), lambda i: F.array_contains(F.col("marks"), F.get(g, i)))
    around = F.transform(places, lambda p: F.sequence(F.least(F.greatest(p - (window - 1), F.lit(0)), last), F.least(p, last)))
    return F.array_distinct(F.flatten(around))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row."""
    spark = docs.sparkSession
    with Stages(spark) as stages:
        items = stages.write(
            benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("ws"))
            .filter(F.size("ws") > 0).withColumn("len", F.least(F.lit(WINDOW), F.size("ws"))), "items")
        lengths = sorted(r[0] for r in items.select("len").distinct().collect())      # WINDOW values at most
        marked = with_grams(items, lengths)
        marks = None
        for n in lengths:
            k, w = shape(n)
            some = marked.filter(F.col("len") == n).select(F.explode(winnow(f"g{k}", w)).alias("mark"))
            marks = some if marks is None else marks.unionAll(some)

        docs_ = docs.select("doc_id", "text")
        key = F.xxhash64("text").alias("h")
        first = docs_.select(F.monotonically_increasing_id().alias("row"), "doc_id", key, words(F.col("text")).alias("ws"))
        if not lengths:
            counted = stages.write(first.select("row", "doc_id", "h", F.size("ws").cast("long").alias("n_words"), F.array().cast("array<bigint>").alias("marks")), "counted", keep=True)
            hits = spark.createDataFrame([], "h long, named string, at int, len int").join(counted.select("h", "doc_id").limit(0), "h")
            sets = spark.createDataFrame([], "named string, item string")
        else:
            grams = with_grams(first, lengths)
            found = F.array_distinct(F.concat(*[winnow(f"g{shape(n)[0]}", shape(n)[1]) for n in lengths]))
            rows = grams.select("row", "doc_id", "h", F.size("ws").cast("long").alias("n_words"), F.explode_outer(found).alias("mark"))
            marks = stages.write(marks.distinct(), "marks").withColumn("hit", F.col("mark"))
            joined = rows.join(broadcast_below(marks, F.lit(16), BROADCAST_BYTES), "mark", "left")
            counted = stages.write(joined.groupBy("row", "doc_id", "h", "n_words").agg(F.collect_set("hit").alias("marks")), "counted", keep=True)

            windows = items.select("item", "len", F.explode(F.transform(F.sequence(F.lit(1), F.size("ws") - F.col("len") + 1),
                                                                        lambda i: F.array_join(F.slice("ws", i, F.col("len")), " "))).alias("run"))
            # a null beside the names stands for the item without an id
            windows = windows.groupBy("run", "len").agg(F.array_sort(F.collect_set("item")).alias("items"), F.max(F.col("item").isNull()).alias("other"))
            names = F.when(F.col("other"), F.concat("items", F.array(F.lit(None).cast("string")))).otherwise(F.col("items"))
            windows = stages.write(windows.select("run", "len", names.alias("items")).withColumn("named", F.md5(F.to_json("items").cast("binary"))), "windows")
            sets = windows.select("named", "items").dropDuplicates(["named"]).select("named", F.explode("items").alias("item"))
            suspects = counted.filter(F.size("marks") > 0).select("doc_id", "h", "marks").dropDuplicates(["doc_id", "h"])
            near = broadcast_below(suspects.withColumnRenamed("doc_id", "_id"), 32 + 16 * F.size("marks"), BROADCAST_BYTES)
            again = docs_.withColumn("h", F.xxhash64("text")).join(near, ["h"]).filter(F.col("doc_id").eqNullSafe(F.col("_id")))
            again = with_grams(again.dropDuplicates(["doc_id", "h"]).select("doc_id", "h", "marks", words(F.col("text")).alias("ws")), lengths)
            runs = None
            for n in lengths:
                part = again.filter(F.size("ws") >= n).select("doc_id", "h", "ws", F.explode(window_starts(n)).alias("at")).select(
                    "doc_id", "h", "at", F.lit(n).alias("len"), F.array_join(F.slice("ws", F.col("at") + 1, F.lit(n)), " ").alias("run"))
                runs = part if runs is None else runs.unionAll(part)
            known = broadcast_below(windows.select("run", "len", "named"), 64 + F.octet_length("run"), BROADCAST_BYTES)
            hits = stages.write(runs.join(known, ["run", "len"]).select("doc_id", "h", "named", "at", "len"), "hits")

        covered = (hits.select("doc_id", "h", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("len") - 1)).alias("pos")).distinct()
                   .groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("n_hit")))
        named = stages.write(hits.groupBy("doc_id", "h").agg(F.array_sort(F.collect_set("named")).alias("all")), "named")
        # each combination of keys that occurs is resolved once
        each = named.select("all").distinct().select("all", F.explode("all").alias("named"))
        each = each.join(broadcast_below(sets, 48 + F.octet_length(F.coalesce("item", F.lit(""))), BROADCAST_BYTES), "named")
        items_ = F.array_sort(F.collect_set("item"))
        each = each.groupBy("all").agg((F.size(items_) + F.max(F.col("item").isNull().cast("int"))).cast("long").alias("n_items"),
                                       F.sha2(F.array_join(items_, ","), 256).alias("items_sha256"))
        named = named.join(each, "all").drop("all")
        same = lambda a, b: (a["h"].eqNullSafe(b["h"])) & (a["doc_id"].eqNullSafe(b["doc_id"]))
        found = stages.write(covered.alias("c").join(named.alias("n"), same(covered, named)).select("c.doc_id", "c.h", "n_hit", "n_items", "items_sha256"), "found", keep=True)
    out = counted.join(found, same(counted, found), "left")
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return out.select(counted["doc_id"], "n_words", n_hit.alias("n_hit"), F.coalesce(F.col("n_items"), F.lit(0)).cast("long").alias("n_items"),
                      F.coalesce(F.col("items_sha256"), F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The same rows by comparing every run of words with every window.
ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
iw AS (SELECT item_id, least(10, len(ws)) AS n, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS s FROM i WHERE len(ws) > 0),
it AS (SELECT DISTINCT item_id, n, array_to_string(ws[s:s + n - 1], ' ') AS run FROM iw),
ds AS (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM it) WHERE len(ws) >= n),
dt AS (SELECT doc_id, n, s, array_to_string(ws[s:s + n - 1], ' ') AS run FROM ds),
hit AS (SELECT doc_id, item_id, s, dt.n FROM dt JOIN it ON dt.run = it.run AND dt.n = it.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
nam AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS xs
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(xs, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN nam USING (doc_id)
"""
