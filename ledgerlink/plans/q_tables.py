"""Registered queries: cleaning, dedupe, counts, batching, corrections, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlink.functions import text as TX
from ledgerlink.functions.cols import round_half_away
from ledgerlink.operators import relational as RL
from ledgerlink.plans import bindings as B
from ledgerlink.plans.registry import register
from ledgerlink.session import bounded_broadcast

S = B.SPEC


def _part(spark, sf):
    return B.table(spark, sf, "part")


# levels of a hierarchy with holes, general -> specific (FIXTURES §4)
def _levels(spark, sf):
    p = _part(spark, sf)
    return p.select("p_partkey",
                    F.col("p_type").alias("dom"),
                    F.when(F.col("p_size") % 2 == 0, F.lit(None)).otherwise(F.col("p_brand")).alias("fam"),
                    F.when(F.col("p_size") % 3 == 0, F.lit(None)).otherwise(F.col("p_name")).alias("sfam"))


SQL_LEVELS = """levels AS (
  SELECT p_partkey, p_type AS dom,
         CASE WHEN p_size % 2 = 0 THEN NULL ELSE p_brand END AS fam,
         CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_name END AS sfam FROM part)"""


@register("distinct_rows", """
SELECT DISTINCT l_returnflag, l_linestatus, l_partkey FROM lineitem""")
def distinct_rows(spark, sf):
    li = B.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_partkey")
    return RL.distinct_rows(li)


@register("distinct_keep_first", """
SELECT p_name, p_partkey, p_type, p_brand FROM (
  SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn FROM part) WHERE rn = 1""")
def distinct_keep_first(spark, sf):
    p = _part(spark, sf).select("p_name", "p_partkey", "p_type", "p_brand")
    return RL.distinct_keep_first(p, ["p_name"], "p_partkey")


@register("value_counts", """
SELECT src AS source, CAST(count(*) AS BIGINT) AS count FROM (
  SELECT CASE WHEN source = 'src0' THEN NULL ELSE source END AS src FROM documents)
WHERE src IS NOT NULL GROUP BY src""")
def value_counts(spark, sf):
    d = B.table(spark, sf, "documents").select(
        F.when(F.col("source") == "src0", F.lit(None)).otherwise(F.col("source")).alias("source"))
    return RL.value_counts(d, "source")


@register("value_share", """
SELECT source, CAST(count(*) AS BIGINT) AS count,
       round(count(*) / sum(count(*)) OVER (), 9) AS share FROM documents GROUP BY source""")
def value_share(spark, sf):
    d = B.table(spark, sf, "documents")
    s = RL.value_share(RL.value_counts(d, "source"))
    return s.withColumn("share", round_half_away(F.col("share"), 9))


@register("dropna_all", B.with_sql(SQL_LEVELS, """
SELECT p_partkey, fam, sfam FROM levels WHERE fam IS NOT NULL OR sfam IS NOT NULL"""))
def dropna_all(spark, sf):
    return RL.dropna_all(_levels(spark, sf).select("p_partkey", "fam", "sfam"), ["fam", "sfam"])


@register("hierarchical_select", B.with_sql(SQL_LEVELS, """
SELECT p_partkey, coalesce(sfam, fam, dom) AS level_text FROM levels"""))
def hierarchical_select(spark, sf):
    lv = _levels(spark, sf)
    return lv.select("p_partkey", TX.hierarchical_select(["dom", "fam", "sfam"]).alias("level_text"))


@register("concat_description", """
SELECT p_partkey, p_name || ', ' || CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_type END AS description
FROM part""")
def concat_description(spark, sf):
    p = _part(spark, sf)
    geo = F.when(F.col("p_size") % 5 == 0, F.lit(None)).otherwise(F.col("p_type"))
    return p.select("p_partkey", TX.concat_description(F.col("p_name"), geo).alias("description"))


@register("sample_n", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY md5(concat_ws('|', l_orderkey, l_linenumber, 42)), l_orderkey, l_linenumber LIMIT 1000""")
def sample_n(spark, sf):
    """Exactly 1,000 lines (all of them if fewer), repeatable by seed."""
    li = B.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return RL.sample_n(li, 1000, ["l_orderkey", "l_linenumber"], seed=42)


@register("head_n", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_orderkey, l_linenumber, l_extendedprice LIMIT 5""")
def head_n(spark, sf):
    li = B.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return RL.head_n(li, ["l_orderkey", "l_linenumber", "l_extendedprice"], 5)


@register("surrogate_key", """
SELECT p_partkey, p_name,
       md5(concat_ws(chr(1), coalesce(p_name, chr(2)), coalesce(p_type, chr(2)), coalesce(p_brand, chr(2)))) AS sk,
       row_number() OVER (ORDER BY p_name, p_partkey) - 1 AS row_id FROM part""")
def surrogate_key(spark, sf):
    p = _part(spark, sf).select("p_partkey", "p_name", "p_type", "p_brand")
    keyed = p.select("p_partkey", "p_name", RL.content_key(["p_name", "p_type", "p_brand"], "sk"))
    return RL.dense_row_id(keyed, ["p_name", "p_partkey"], "row_id")


@register("union_missing_columns", B.with_sql(B.SQL_MONEY_CATALOGUE, """
SELECT cat_code, cat_description, ef, NULL::VARCHAR AS description_fr FROM catalogue
UNION ALL
SELECT DISTINCT substr(p_type, 1, 2), NULL, NULL, lower(p_type) FROM part"""))
def union_missing_columns(spark, sf):
    leaves = B.money_catalogue(spark, sf).select("cat_code", "cat_description", "ef")
    domains = _part(spark, sf).select(F.substring("p_type", 1, 2).alias("cat_code"),
                                      F.lower("p_type").alias("description_fr")).distinct()
    return RL.union_missing_columns([leaves, domains])


WS = TX.whitespace_class()
SQL_TOKENS = f"""doc_tokens AS (
  SELECT doc_id, CAST(CASE WHEN t = '' THEN 0 ELSE len(regexp_split_to_array(t, '{WS}+')) END AS BIGINT) AS tokens
  FROM (SELECT doc_id, regexp_replace(text, '^{WS}+|{WS}+$', '', 'g') AS t FROM documents))"""


@register("token_budget_batches", f"""
WITH RECURSIVE {SQL_TOKENS},
placed AS (SELECT doc_id, tokens, CAST(sum(tokens) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - tokens AS BIGINT) AS tokens_before FROM doc_tokens),
starts AS (
  SELECT CAST(0 AS BIGINT) AS pos
  UNION ALL
  SELECT nxt FROM (SELECT (SELECT min(tokens_before) FROM placed
                           WHERE tokens > 0 AND tokens_before > pos AND tokens_before + tokens > pos + {S.token_budget}) AS nxt FROM starts) WHERE nxt IS NOT NULL)
SELECT doc_id, tokens, tokens_before,
       CAST((SELECT count(*) FROM starts WHERE starts.pos < placed.tokens_before OR (starts.pos = placed.tokens_before AND (placed.tokens > 0 OR pos = 0))) - 1 AS BIGINT) AS batch_id
FROM placed""")
def token_budget_batches(spark, sf):
    d = B.table(spark, sf, "documents").select("doc_id", TX.word_count(F.col("text")).alias("tokens"))
    return RL.token_budget_batches(d, ["doc_id"], "tokens", S.token_budget)


FIXED_BATCH = 64


@register("fixed_batches", f"""
SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_index,
       CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / {FIXED_BATCH}) AS BIGINT) AS batch_id
FROM documents""")
def fixed_batches(spark, sf):
    d = B.table(spark, sf, "documents").select("doc_id")
    return RL.fixed_batches(d, ["doc_id"], FIXED_BATCH)


# corrections keyed by the article text; one unknown column is ignored (Q9), and
# every key is repeated with a row that corrects only the type
def corrections(spark, sf):
    p = _part(spark, sf)
    once = p.groupBy("p_name").agg(
        F.max("p_type").alias("p_type"),
        F.when(F.col("p_name").contains("ring"), F.lit(None)).otherwise(F.min("p_brand")).alias("p_brand"),
        F.lit("x").alias("not_in_source"))
    return once.unionByName(once.withColumn("p_type", F.concat("p_type", F.lit(" (2)"))).withColumn("p_brand", F.lit(None).cast("string")))


@register("apply_corrections", """
WITH corr AS (SELECT p_name, max(p_type) AS p_type,
                     CASE WHEN contains(p_name, 'ring') THEN NULL ELSE min(p_brand) END AS p_brand
              FROM part GROUP BY p_name)
SELECT s.p_partkey, s.p_name, coalesce(c.p_type, s.p_type) AS p_type,
       coalesce(c.p_brand, s.p_brand) AS p_brand
FROM part s LEFT JOIN corr c ON c.p_name = s.p_name""")
def apply_corrections(spark, sf):
    src = _part(spark, sf).select("p_partkey", "p_name", "p_type", "p_brand")
    return RL.apply_corrections(src, corrections(spark, sf), "p_name")


@register("join_back_matches", B.with_sql(B.SQL_PURCHASES, """
uniq AS (SELECT article, min(cat_code) AS chosen_code FROM purchases GROUP BY article)""", """
SELECT l_orderkey, l_linenumber, p.article, u.chosen_code
FROM purchases p JOIN uniq u ON u.article = p.article"""))
def join_back_matches(spark, sf):
    """Results computed once per distinct text, joined back to every line."""
    from ledgerlink.operators.matching import join_back
    lines = B.purchases(spark, sf).select("l_orderkey", "l_linenumber", "article", "cat_code")
    uniq = lines.groupBy("article").agg(F.min("cat_code").alias("chosen_code"))
    return join_back(lines.drop("cat_code"), uniq, "article")


@register("prefixed_join", """
SELECT s.s_suppkey, s.s_name, s.s_nationkey AS nation, n.n_name AS "target.n_name", n.n_regionkey AS "target.n_regionkey"
FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey""")
def prefixed_join(spark, sf):
    """P5: the looked-up side's columns are prefixed before the join, so that no name
    of the two sides can collide; its key goes again."""
    nation = RL.prefix_columns(B.table(spark, sf, "nation").select(F.col("n_nationkey").alias("nation"), "n_name", "n_regionkey"), "target.", keep=["nation"])
    rows = B.table(spark, sf, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("nation"))
    return rows.join(bounded_broadcast(nation, 100_000), "nation").select("s_suppkey", "s_name", "nation", "`target.n_name`", "`target.n_regionkey`")
