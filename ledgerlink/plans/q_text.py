"""Registered queries: text, date and JSON functions, translation, profiling.

Text functions run over every document's whole text.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlink.functions import dates as DT
from ledgerlink.functions import json as JS
from ledgerlink.functions import text as TX
from ledgerlink.functions.cols import round_half_away
from ledgerlink.operators import profile as PR
from ledgerlink.operators import relational as RL
from ledgerlink.operators import translate as TR
from ledgerlink.plans import bindings as B
from ledgerlink.plans.registry import register

WS = TX.whitespace_class()
AWS = TX.ascii_whitespace_class()


def R(col, d):
    return round_half_away(F.col(col) if isinstance(col, str) else col, d)


def _docs(spark, sf):
    return B.table(spark, sf, "documents")


@register("clean_catalogue_text", f"""
SELECT doc_id, regexp_replace(text, '{WS}+$', '') AS text FROM documents""")
def clean_catalogue_text(spark, sf):
    """right-strip in Python's sense (tab, newline, NBSP, ...)."""
    return _docs(spark, sf).select("doc_id", TX.rstrip_unicode("text").alias("text"))


@register("clean_codes", f"""
SELECT p_partkey, replace(regexp_replace(code, '^{WS}+|{WS}+$', '', 'g'), '.', '') AS code FROM (
  SELECT p_partkey, ' ' || substr(p_type, 1, 2) || '.' || regexp_extract(p_brand, '#(\\d+)', 1) || '.x' || chr(160) AS code
  FROM part)""")
def clean_codes(spark, sf):
    """strip both ends, then remove literal dots (``EC.17.x`` -> ``EC17x``)."""
    p = B.table(spark, sf, "part")
    raw = F.concat(F.lit(" "), F.substring("p_type", 1, 2), F.lit("."),
                   F.regexp_extract("p_brand", r"#(\d+)", 1), F.lit(".x "))
    return p.select("p_partkey", TX.remove_dots(TX.strip_unicode(raw)).alias("code"))


@register("strip_digits", """
SELECT doc_id, regexp_replace(text, '\\p{Nd}+', '', 'g') AS text FROM documents""")
def strip_digits(spark, sf):
    """remove (Unicode) digit runs."""
    return _docs(spark, sf).select("doc_id", TX.strip_digits("text").alias("text"))


SQL_HOLES = """holes AS (
  SELECT p_partkey, p_name, p_type,
         CASE WHEN p_size % 7 = 0 THEN '' WHEN p_size % 2 = 0 THEN NULL ELSE p_brand END AS brand
  FROM part)"""


def _holes(spark, sf):
    p = B.table(spark, sf, "part")
    return p.select("p_partkey", "p_name", "p_type",
                    F.when(F.col("p_size") % 7 == 0, F.lit(""))
                    .when(F.col("p_size") % 2 == 0, F.lit(None)).otherwise(F.col("p_brand")).alias("brand"))


@register("combine_columns", B.with_sql(SQL_HOLES, """
SELECT p_partkey, concat_ws(' ', coalesce(p_name, ''), coalesce(brand, ''), coalesce(p_type, '')) AS combined
FROM holes"""))
def combine_columns(spark, sf):
    """one blank between columns, nulls as empty text (double blanks stay)."""
    h = _holes(spark, sf)
    return h.select("p_partkey", TX.combine_columns(["p_name", "brand", "p_type"]).alias("combined"))


@register("emphasize_columns", B.with_sql(SQL_HOLES, """
SELECT p_partkey, CASE WHEN coalesce(brand, '') = '' THEN '' ELSE '*' || brand || '*' END AS brand
FROM holes"""))
def emphasize_columns(spark, sf):
    """``*text*``; null and empty text give empty text."""
    h = _holes(spark, sf)
    return h.select("p_partkey", TX.emphasize("brand").alias("brand"))


@register("normalize_text", f"""
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(strip_accents(text), '[^\\x00-\\x7F]+', '', 'g'),
                              '{AWS}+', ' ', 'g'), '^ +| +$', '', 'g') AS text FROM documents""")
def normalize_text(spark, sf):
    """F8: NFKD to ASCII, collapse whitespace, trim (whole documents)."""
    return _docs(spark, sf).select("doc_id", TX.normalize_text("text").alias("text"))


WRAP_N = 12


@register("wrap_words", f"""
WITH w AS (SELECT doc_id, regexp_replace(text, '^{WS}+|{WS}+$', '', 'g') AS t FROM documents),
ws AS (SELECT doc_id, CASE WHEN t = '' THEN []::VARCHAR[] ELSE regexp_split_to_array(t, '{WS}+') END AS w FROM w)
SELECT doc_id, CASE WHEN len(w) = 0 THEN '' ELSE array_to_string(
         list_transform(range(0, CAST(ceil(len(w) / {WRAP_N}) AS BIGINT)),
                        lambda i: array_to_string(w[i * {WRAP_N} + 1 : i * {WRAP_N} + {WRAP_N}], ' ')), '<br>') END AS wrapped
FROM ws""")
def wrap_words(spark, sf):
    """lines of 12 words joined by ``<br>``."""
    return _docs(spark, sf).select("doc_id", TX.wrap_words("text", WRAP_N).alias("wrapped"))


@register("share_labels", """
SELECT source, source || ' (' || printf('%.1f', round_even(count(*) / sum(count(*)) OVER () * 100, 1)) || '%)' AS label
FROM documents GROUP BY source""")
def share_labels(spark, sf):
    """A5+F12: ``source (12.3%)`` labels for a treemap."""
    s = RL.value_share(RL.value_counts(_docs(spark, sf), "source"))
    return s.select("source", TX.share_label("source", "share").alias("label"))


SQL_DATE_TEXT = """dt AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_linenumber = 1 THEN strftime(l_shipdate, '%Y-%m-%d')
              WHEN l_linenumber = 2 THEN '31' || strftime(l_shipdate, '/%m/%Y')
              ELSE strftime(l_shipdate, '%d/%m/%Y') END AS date_text FROM lineitem)"""


@register("parse_dates", B.with_sql(SQL_DATE_TEXT, """
SELECT l_orderkey, l_linenumber, date_text,
       strftime(try_strptime(date_text, '%d/%m/%Y'), '%Y-%m-%d') AS parsed,
       try_strptime(date_text, '%d/%m/%Y') IS NULL AS quarantined FROM dt"""))
def parse_dates(spark, sf):
    """``dd/MM/yyyy`` text to dates; ISO text and impossible days
    (31 February) become null and are flagged for quarantine, not fatal."""
    li = B.table(spark, sf, "lineitem")
    d = F.col("l_shipdate")
    txt = (F.when(F.col("l_linenumber") == 1, F.date_format(d, "yyyy-MM-dd"))
           .when(F.col("l_linenumber") == 2, F.concat(F.lit("31"), F.date_format(d, "/MM/yyyy")))
           .otherwise(F.date_format(d, "dd/MM/yyyy")))
    x = li.select("l_orderkey", "l_linenumber", txt.alias("date_text"))
    p = DT.parse_date("date_text", "dd/MM/yyyy")
    return x.select("l_orderkey", "l_linenumber", "date_text",
                    F.date_format(p, "yyyy-MM-dd").alias("parsed"), p.isNull().alias("quarantined"))


@register("month_key", """
SELECT strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS month_start,
       strftime(l_shipdate, '%Y-%m') AS month, CAST(count(*) AS BIGINT) AS n_lines
FROM lineitem GROUP BY 1, 2""")
def month_key(spark, sf):
    """first day of the month and ``yyyy-MM`` text."""
    li = B.table(spark, sf, "lineitem")
    return (li.groupBy(F.date_format(DT.month_start("l_shipdate"), "yyyy-MM-dd").alias("month_start"),
                       DT.month_text("l_shipdate").alias("month"))
            .agg(F.count(F.lit(1)).alias("n_lines")))


@register("rows_to_json", """
SELECT p_partkey, json_object('p_partkey', p_partkey, 'p_name', p_name, 'p_type', p_type)::VARCHAR AS record
FROM part""")
def rows_to_json(spark, sf):
    """one JSON record per row."""
    p = B.table(spark, sf, "part")
    return p.select("p_partkey", JS.rows_to_json([F.col("p_partkey"), F.col("p_name"), F.col("p_type")]).alias("record"))


SQL_ANSWERS = """ans AS (
  SELECT event_id,
         CASE WHEN event_type = 'error' THEN 'oops'
              ELSE '{"' || CAST(event_id AS VARCHAR) || '": {"ID": ' || CAST(json_extract(props, '$.k') AS VARCHAR)
                   || ', "Chosen option": "' || event_type || '"}}' END AS answer FROM events)"""


@register("parse_json_answers", B.with_sql(SQL_ANSWERS, """
SELECT event_id, e.key AS row_key, CAST(e.value."ID" AS VARCHAR) AS chosen_id, e.value."Chosen option" AS chosen_option,
       m IS NULL AS malformed
FROM (SELECT event_id, try(json_transform(answer,
        '"MAP(VARCHAR, STRUCT(\\"ID\\" BIGINT, \\"Chosen option\\" VARCHAR))"')) AS m FROM ans)
LEFT JOIN LATERAL (SELECT unnest(map_entries(m)) AS e) ON true"""))
def parse_json_answers(spark, sf):
    """chooser answers ``{"<row>": {"ID": .., "Chosen option": ..}}`` (built
    from ``events.props``) parsed to rows; malformed answers give one row with
    nulls and ``malformed = true`` instead of failing."""
    ev = B.table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    answer = F.when(F.col("event_type") == "error", F.lit("oops")).otherwise(F.concat(
        F.lit('{"'), F.col("event_id").cast("string"), F.lit('": {"ID": '), k,
        F.lit(', "Chosen option": "'), F.col("event_type"), F.lit('"}}')))
    x = ev.select("event_id", JS.parse_json(answer, JS.CHOICE_SCHEMA).alias("m"))
    x = x.select("event_id", F.col("m").isNull().alias("malformed"), F.explode_outer("m").alias("row_key", "v"))
    return x.select("event_id", "row_key", F.col("v.ID").cast("string").alias("chosen_id"),
                    F.col("v.`Chosen option`").alias("chosen_option"), "malformed")


# A short French -> English glossary for the translation binding.
GLOSSARY = {
    "le": "the", "la": "the", "les": "the", "de": "of", "des": "of", "du": "of the",
    "et": "and", "un": "a", "une": "a", "qui": "who", "que": "that", "en": "in",
    "dans": "in", "pour": "for", "avec": "with", "sur": "on", "par": "by", "est": "is",
    "elle": "she", "il": "he", "aux": "to the", "ou": "or",
}


def glossary_table(spark):
    return spark.createDataFrame(sorted(GLOSSARY.items()), "source string, target string")


SQL_GLOSSARY = "gl(source, target) AS (VALUES " + ", ".join(
    f"('{k}', '{v}')" for k, v in sorted(GLOSSARY.items())) + ")"


@register("translate_glossary", B.with_sql(SQL_GLOSSARY, """u AS (SELECT DISTINCT text FROM documents),
tok AS (SELECT text, unnest(string_split(text, ' ')) AS w, unnest(generate_series(1, len(string_split(text, ' ')))) AS pos FROM u),
tr AS (SELECT text, string_agg(coalesce(g.target, w), ' ' ORDER BY pos) AS translated
       FROM tok LEFT JOIN gl g ON g.source = lower(w) GROUP BY text)""", """
SELECT d.doc_id, tr.translated AS text, d.text AS "text original"
FROM documents d LEFT JOIN tr ON tr.text = d.text"""))
def translate_glossary(spark, sf):
    """M8: all documents translated word by word; the source text is kept as
    ``text original``."""
    d = _docs(spark, sf).select("doc_id", "text")
    out = TR.translate_columns(d, ["text"], glossary_table(spark))
    return out.select("doc_id", "text", "text original")


@register("prompt_texts", f"""
SELECT doc_id, left(replace(text, chr(10), ' '), {B.SPEC.rep_text_chars}) AS text FROM documents""")
def prompt_texts(spark, sf):
    """every document's text as it goes into a prompt: line ends to blanks,
    cut at ``spec.rep_text_chars`` characters."""
    return _docs(spark, sf).select("doc_id", TX.cut_text(TX.newline_to_blank("text"), B.SPEC.rep_text_chars).alias("text"))


#: Phrases that overlap each other, in part or whole.
PHRASES = {"the": "le", "of the": "du", "the the": "le meme", "the the of": "le tout du", "of": "de", "and the": "et le", "the and": "le et",
           "the and the": "les deux", "der": "the", "der der": "the same", "der der die": "the same one", "die der": "who of the",
           "de la": "of her", "la de": "her of", "la de la": "here and there", "de": "from", "is the": "est le", "to the": "au"}
SQL_PHRASES = "gl(source, target) AS (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in sorted(PHRASES.items())) + ")"


@register("translate_phrases", "WITH RECURSIVE " + SQL_PHRASES + """,
u AS (SELECT text, string_split(text, ' ') AS w, string_split(lower(text), ' ') AS k FROM (SELECT DISTINCT text FROM documents)),
tok AS (SELECT text, unnest(w) AS w, unnest(range(len(w))) AS pos, unnest(k) AS first FROM u),
heads AS (SELECT source, target, len(string_split(source, ' ')) AS words, string_split(source, ' ')[1] AS first FROM gl),
hits AS (SELECT u.text, pos, words, target FROM tok JOIN heads USING (first) JOIN u ON u.text = tok.text
         WHERE array_to_string(u.k[pos + 1 : pos + words], ' ') = source),
longest AS (SELECT text, pos, max(words) AS words, arg_max(target, words) AS target FROM hits GROUP BY text, pos),
linked AS (SELECT a.*, b.pos AS nxt FROM longest a ASOF LEFT JOIN longest b ON a.text = b.text AND b.pos >= a.pos + a.words),
taken AS (
  SELECT text, pos, words, target, nxt FROM linked WHERE (text, pos) IN (SELECT (text, min(pos)) FROM longest GROUP BY text)
  UNION ALL
  SELECT l.* FROM taken t JOIN linked l ON l.text = t.text AND l.pos = t.nxt),
shown AS (
  SELECT tok.text, tok.pos, CASE WHEN t.pos IS NULL THEN tok.w WHEN t.pos = tok.pos THEN t.target END AS w
  FROM tok ASOF LEFT JOIN (SELECT text, pos, words, target FROM taken UNION ALL SELECT text, pos + words, 0, NULL FROM taken
                           WHERE (text, pos + words) NOT IN (SELECT (text, pos) FROM taken)) t0 ON t0.text = tok.text AND t0.pos <= tok.pos
  LEFT JOIN taken t ON t.text = t0.text AND t.pos = t0.pos AND tok.pos < t.pos + t.words),
tr AS (SELECT text, string_agg(w, ' ' ORDER BY pos) AS translated FROM shown WHERE w IS NOT NULL GROUP BY text)
SELECT d.doc_id, tr.translated AS text, d.text AS "text original" FROM documents d LEFT JOIN tr ON tr.text = d.text""")
def translate_phrases(spark, sf):
    """M8: all documents translated by phrases that overlap, leftmost-longest."""
    glossary = spark.createDataFrame(sorted(PHRASES.items()), "source string, target string")
    return TR.translate_phrases(_docs(spark, sf).select("doc_id", "text"), ["text"], glossary).select("doc_id", "text", "text original")


# M9 over the purchase lines rendered as text columns (same text in both engines)
def _profile_input(spark, sf):
    p = B.purchases(spark, sf)
    return p.select(F.date_format("ship_date", "yyyy-MM-dd").alias("order_date"),
                    F.col("amount").cast("decimal(18,2)").cast("string").alias("total_amount"),
                    F.col("currency"), F.col("article"), F.col("entity"), F.col("segment"),
                    F.col("l_orderkey").cast("string").alias("order_no"))


SQL_PROFILE_INPUT = f"""{B.SQL_PURCHASES},
pin AS (SELECT strftime(ship_date, '%Y-%m-%d') AS order_date,
               CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR) AS total_amount, currency, article, entity,
               segment, CAST(l_orderkey AS VARCHAR) AS order_no FROM purchases),
lng AS (SELECT unnest(['order_date', 'total_amount', 'currency', 'article', 'entity', 'segment', 'order_no']) AS "column",
               unnest([order_date, total_amount, currency, article, entity, segment, order_no]) AS value FROM pin),
prof AS (
  SELECT "column", CAST(count(value) AS BIGINT) AS n_nonnull, CAST(count(DISTINCT value) AS BIGINT) AS n_distinct,
         sum(CASE WHEN (regexp_matches(value, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') AND try_strptime(value, '%Y-%m-%d') IS NOT NULL) OR (regexp_matches(value, '^\\d{{2}}/\\d{{2}}/\\d{{4}}$') AND try_strptime(value, '%d/%m/%Y') IS NOT NULL) THEN 1 ELSE 0 END) / count(value) AS date_share,
         sum(CASE WHEN regexp_matches(value, '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$') AND try_cast(value AS DOUBLE) IS NOT NULL THEN 1 ELSE 0 END) / count(value) AS number_share,
         avg(length(value)) AS avg_len,
         avg(CASE WHEN regexp_replace(value, '^{WS}+|{WS}+$', '', 'g') = '' THEN 0
                  ELSE len(regexp_split_to_array(regexp_replace(value, '^{WS}+|{WS}+$', '', 'g'), '{WS}+')) END) AS avg_words
  FROM lng GROUP BY "column")"""


@register("profile_columns", "WITH " + SQL_PROFILE_INPUT + """
SELECT "column", n_nonnull, n_distinct, round(date_share, 9) AS date_share, round(number_share, 9) AS number_share,
       round(avg_len, 9) AS avg_len, round(avg_words, 9) AS avg_words FROM prof""")
def profile_columns(spark, sf):
    """M9: one-pass profile of every column of the purchase lines."""
    pr = PR.profile_columns(_profile_input(spark, sf))
    return pr.select("column", "n_nonnull", "n_distinct", *[R(x, 9).alias(x) for x in
                                                            ["date_share", "number_share", "avg_len", "avg_words"]])


@register("infer_roles", "WITH " + SQL_PROFILE_INPUT + """,
pick AS (
  SELECT 'date_column' AS role, arg_min("column", (-date_share, "column")) FILTER (WHERE date_share >= 0.9) AS "column" FROM prof
  UNION ALL SELECT 'amount_column', arg_min("column", (-n_distinct, "column")) FILTER (WHERE number_share >= 0.9 AND date_share < 0.9) FROM prof
  UNION ALL SELECT 'unit_column', arg_min("column", (n_distinct, "column")) FILTER (WHERE number_share < 0.5 AND date_share < 0.5 AND avg_len <= 4) FROM prof
  UNION ALL SELECT 'description_column', arg_min("column", (-avg_words, "column")) FILTER (WHERE number_share < 0.5 AND date_share < 0.5 AND avg_words >= 1.5) FROM prof
  UNION ALL SELECT 'contextual_column', arg_min("column", (-n_distinct, "column")) FILTER (WHERE number_share < 0.5 AND date_share < 0.5 AND avg_len > 4 AND avg_words < 1.5) FROM prof)
SELECT role, "column" FROM pick""")
def infer_roles(spark, sf):
    """M9/P20: date, amount, unit, description and context columns by rule."""
    return PR.infer_roles(PR.profile_columns(_profile_input(spark, sf)))
