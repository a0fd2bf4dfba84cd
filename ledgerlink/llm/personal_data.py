"""Personal data: pattern spans, and terms that disclose them.

Base spans are e-mail addresses, IP addresses, card and phone numbers. Each
distinct value found is a protected entity; all words of a text that holds it,
base spans aside, stand with it. Over the whole corpus the share of the documents
with a term in which the term stands with the entity, p(e|t) = n(e,t) / n(t),
says how strongly the term reveals it: its pointwise mutual information
log(p(e|t) / p(e)) reaches ``ALPHA`` of the entity's information content
-log p(e) exactly when p(e|t) >= p(e) ** (1 - ALPHA). Such a term is marked
at all its places in texts that hold that entity, if it stands with it in at least
``CONTEXTS`` different contexts (copies of one text are one context and prove
nothing). ``REACH`` only tells contexts apart: that of a word within so many
characters of a mention is the text that far around the mention; a word further
off gives one context a document, the words that far around the word itself.
``sanitise`` generalises a base span to its kind and removes disclosing terms.

All of it is DataFrame functions. Pass 1 stores counts, spans and contexts of each
row and shuffles no text; the words of texts that hold an entity with enough
contexts are then counted by row; pass 2 counts the documents of every word, for the
terms that have enough contexts and do not stand in too many other texts already.

Defined cases: a null or empty text has no spans; repeated rows stay and count
as documents; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlink.llm.common import Stages, broadcast_below, table
from ledgerlink.llm.spans import labels, mask, overlaps, with_spans

REACH = 60
ALPHA = 0.8
CONTEXTS = 3
BROADCAST_BYTES = 32 << 20
KINDS = ("email", "ip", "card", "phone")

# Possessive and with fixed beginnings where that changes no match: no backtracking, no recursion on long runs.
# A run of local-part characters can only match from its beginning, or from where the last match ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# Also finds single digits, which are no card and hide none.
CARD = r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PART = r"0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
WORD = r"[\p{L}][\p{L}\p{N}]{2,}"


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    turned = F.split(F.reverse(digits), "")
    values = F.transform(F.filter(turned, lambda c: c != ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        (c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(values, F.lit(0), lambda s, v: s + v) % 10 == 0


def _card(value: Column) -> Column:
    digits = F.regexp_replace(value, "[ -]", "")
    return F.when(F.char_length(digits).between(16, 19), luhn(digits)).otherwise(F.lit(False))


def base_spans(docs: DataFrame) -> DataFrame:
    """Adds the base span columns to rows with ``text``."""
    t = F.col("text")
    df = with_spans(docs, "email", EMAIL, t.contains("@"), lambda v: F.lit(True))
    df = with_spans(df, "ip", IP, t.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"), lambda v: v.rlike(rf"^{_PART}(\.{_PART}){{3}}$"))
    df = with_spans(df, "card", CARD, t.rlike(r"[0-9]([\x20-]?[0-9]){15}"), _card)
    return with_spans(df, "phone", PHONE, t.contains("+"), lambda v: F.char_length(F.regexp_replace(v, "[^0-9]", "")).between(8, 15))


def _words_at(window: Column, offset: Column, cut_left: Column, cut_right: Column) -> Column:
    """(term, start, end) of the words in a short window that begins at offset;
    words that the window's ends may have cut are left out."""
    words = F.regexp_extract_all(window, F.lit(WORD), F.lit(0))
    gaps = F.split(window, WORD, -1)
    size = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + F.char_length(x))
    placed = F.transform(words, lambda w, i: F.struct(
        F.lower(w).alias("term"), (offset + size(F.slice(gaps, 1, i + 1)) + size(F.slice(words, 1, i))).alias("start"),
        (offset + size(F.slice(gaps, 1, i + 1)) + size(F.slice(words, 1, i + 1))).alias("end")))
    return F.filter(placed, lambda p: ~(cut_left & (p["start"] == offset)) & ~(cut_right & (p["end"] == offset + F.char_length(window))))


def mentions(rows: DataFrame) -> DataFrame:
    """(row, hash of the text, entity, context hash, words beside) of every base span."""
    def of(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))

    every = F.flatten(F.array(*[of(k) for k in KINDS]))
    one = rows.select("row", "text", "taken", F.xxhash64("text").alias("body"), F.explode(every).alias("s")).select("row", "text", "taken", "body", "s.*")
    n = F.char_length("text")
    left_at = F.greatest(F.lit(0), F.col("start") - REACH)
    right_to = F.least(n, F.col("end") + REACH)
    one = one.withColumn("left", F.col("text").substr(left_at + 1, F.col("start") - left_at)).withColumn(
        "right", F.col("text").substr(F.col("end") + 1, right_to - F.col("end"))).withColumn("la", left_at).withColumn("open", right_to < n).drop("text")
    words = F.concat(_words_at(F.col("left"), F.col("la"), F.col("la") > 0, F.lit(False)), _words_at(F.col("right"), F.col("end"), F.lit(False), F.col("open")))
    entity = F.concat_ws(":", "kind", F.lower("value"))
    return one.select("row", "body", entity.alias("entity"), F.xxhash64("left", "right").alias("context"),
                      F.filter(words, lambda w: ~overlaps(w["start"], w["end"], F.col("taken"))).alias("words"))


def words_of(rows: DataFrame) -> DataFrame:
    """(row, term, start, end, around) of all words of the rows' texts that touch no
    base span; ``around`` is a hash of the words that begin within ``REACH``
    characters. Places are running sums by row, so a text of many words is no array
    that grows word by word."""
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    gaps = F.transform(F.split("text", WORD, -1), lambda x: F.char_length(x))
    one = rows.select("row", F.posexplode(F.arrays_zip(words.alias("word"), gaps.alias("gap"))).alias("at", "w")).select("row", "at", "w.*").filter("word is not null")
    size = F.char_length("word")
    one = one.withColumn("end", F.sum(F.col("gap") + size).over(Window.partitionBy("row").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    one = one.select("row", F.lower("word").alias("term"), (F.col("end") - size).alias("start"), "end")
    spans = rows.select("row", F.explode("taken").alias("s")).select("row", F.lit(None).cast("string").alias("term"), "s.start", "s.end")
    by_row, is_span = Window.partitionBy("row"), F.col("term").isNull()
    # spans that begin no later may reach into a word; of the later ones the first may begin inside it
    placed = one.unionByName(spans).withColumn("around", F.xxhash64(F.collect_list("term").over(by_row.orderBy("start").rangeBetween(-REACH, REACH))))
    placed = placed.withColumn("before", F.max(F.when(is_span, F.col("end"))).over(by_row.orderBy("start", ~is_span).rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.withColumn("after", F.min(F.when(is_span, F.col("start"))).over(by_row.orderBy(F.desc("start")).rowsBetween(Window.unboundedPreceding, 0)))
    free = (F.coalesce("before", F.lit(0)) <= F.col("start")) & (F.coalesce("after", "end") >= F.col("end"))
    return placed.filter(~is_span & free).drop("before", "after")


def analyse(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows with counts and base spans, disclosing terms' spans by row, pairs of
    entity and disclosing term)."""
    with Stages(docs.sparkSession) as stages:
        rows = base_spans(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text")))
        rows = rows.withColumn("taken", F.flatten(F.array(*[F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for k in KINDS])))
        # one row per document; the text stays only where there is a span
        rows = stages.write(rows.withColumn("text", F.when(F.size("taken") > 0, F.col("text"))), "base", keep=True)
        named = stages.write(mentions(rows.filter("text is not null")), "named")
        # a text gives a pair no more contexts than it has of the entity, its copies the same ones
        able = named.groupBy("entity").agg(F.countDistinct("body", "context").alias("most")).filter(F.col("most") >= CONTEXTS).select("entity")
        able = stages.write(able, "able")
        named = named.join(broadcast_below(able, F.octet_length("entity") + 16, BROADCAST_BYTES), "entity")
        held = stages.write(named.select("row", "entity").distinct(), "held")
        asked = held.select("row").distinct()
        texts = rows.filter("text is not null").join(broadcast_below(asked, F.lit(24), BROADCAST_BYTES), "row", "left_semi")
        words = stages.write(words_of(texts), "words")
        beside = stages.write(named.select("row", "entity", "context", F.explode("words").alias("w")).select("row", "entity", "context", "w.*"), "beside")
        places = words.unionByName(beside.select("row", "term", "start", "end", F.lit(None).cast("long").alias("around")))
        said = stages.write(places.groupBy("row", "term").agg(F.min("around").alias("around")), "said")

        n_all = rows.count()
        with_words = held.join(said.select("row").distinct(), "row", "left_semi")
        n_entity = with_words.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
        # a term has at least the documents counted here: most pairs, those of common
        # words above all, fail already against that number
        n_said = said.groupBy("term").agg(F.count(F.lit(1)).alias("n_said"))
        enough = F.pow(F.col("n_entity") / F.lit(float(n_all)), F.lit(1 - ALPHA))
        spoken = said.join(n_said, "term").join(with_words.join(n_entity, "entity"), "row").filter(F.col("n_entity") / F.col("n_said") >= enough)
        near = beside.select("row", "entity", "term", "context").distinct()
        pairs = spoken.join(near, ["row", "entity", "term"], "left").groupBy("entity", "term", "n_entity", "n_said").agg(
            F.countDistinct(F.coalesce("context", "around")).alias("contexts"), F.countDistinct("row").alias("both"))
        pairs = stages.write(pairs.filter((F.col("contexts") >= CONTEXTS) & (F.col("both") / F.col("n_said") >= enough)), "pairs")

        if not pairs.isEmpty():
            # all words are counted: those asked for would be found by a join that makes a
            # row of nearly every word once there are many pairs
            spoken = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))).alias("term"))
            n_term = spoken.groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
            telling = pairs.join(n_term, "term").filter(F.col("both") / F.greatest("n_term", "both") >= enough).select("entity", "term")
            telling = stages.write(telling, "telling")
            told = held.join(telling, "entity").select("row", "term").distinct()
            marked = places.join(told, ["row", "term"]).select("row", "start", "end").distinct()
        else:
            telling = pairs.select("entity", "term")
            marked = places.select("row", "start", "end").limit(0)
        per_row = marked.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("term"))
        return rows, stages.write(per_row, "terms", keep=True), stages.write(telling, "telling", keep=True)


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row."""
    rows, terms, _ = analyse(docs)
    base = F.concat(*[labels(k, F.col(k)) for k in KINDS])
    out = rows.drop("text", "taken").join(terms, "row", "left").withColumn("base", base)
    extra = F.coalesce(labels("term", F.col("term")), F.array().cast("array<string>"))
    return out.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(F.array_join("base", ","), 256).alias("base_sha256"),
                      F.array_join(F.concat("base", extra), ",").alias("spans"))


def sanitise(docs: DataFrame) -> DataFrame:
    """doc_id, text with base spans generalised to their kind and disclosing terms
    removed, wherever they stand in a text that holds their entity; rows without
    spans are not in the result."""
    def tagged_as(spans: str, tag: str) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(tag).alias("tag")))

    rows, terms, _ = analyse(docs)
    tagged = F.concat(*[tagged_as(k, f"[{k}]") for k in KINDS], F.coalesce(tagged_as("term", ""), F.array().cast("array<struct<start:int,end:int,tag:string>>")))
    # kinds can overlap one another: what begins inside an earlier span is covered by it
    clear = F.aggregate(F.array_sort(tagged), F.array().cast("array<struct<start:int,end:int,tag:string>>"), lambda acc, s: F.when(
        (F.size(acc) == 0) | (s["start"] >= F.element_at(acc, -1)["end"]), F.concat(acc, F.array(s))).otherwise(acc))
    out = rows.filter("text is not null").join(terms, "row", "left").withColumn("clear", clear)
    return out.select("doc_id", mask(F.col("text"), F.col("clear")).alias("text"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    """The same rows in DuckDB SQL, with the patterns as the contract has them."""
    place = "CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT)"
    digits = "regexp_replace(value, '[ -]', '', 'g')"
    luhn = (f"list_sum(list_transform(range(0, length({digits})), lambda i: CASE WHEN i % 2 = 0 THEN CAST(reverse({digits})[i + 1] AS INTEGER) "
            f"ELSE (2 * CAST(reverse({digits})[i + 1] AS INTEGER)) % 10 + (2 * CAST(reverse({digits})[i + 1] AS INTEGER)) // 10 END)) % 10 = 0")
    kinds = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", rf"regexp_full_match(value, '{_PART}(\.{_PART}){{3}}')"),
             ("card", r"[0-9]([\x20-]?[0-9])+", f"CASE WHEN length({digits}) BETWEEN 16 AND 19 THEN {luhn} ELSE false END"),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(regexp_replace(value, '[^0-9]', '', 'g')) BETWEEN 8 AND 15"))
    spans = " UNION ALL ".join(
        f"SELECT row, '{k}' AS kind, {n} AS ko, value, st, st + length(value) AS en FROM (SELECT row, m[i] AS value, {place} AS st FROM ("
        f"SELECT row, m, g, unnest(range(1, len(m) + 1)) AS i FROM (SELECT row, regexp_extract_all(text, '{p}') AS m, regexp_split_to_array(text, '{p}') AS g FROM d))) WHERE {v}"
        for n, (k, p, v) in enumerate(kinds))
    word = r"[\p{L}][\p{L}\p{N}]{2,}"
    sides = " UNION ALL ".join(
        f"SELECT row, entity, context, {at} AS off, {txt} AS win, {left} AS cut_l, {right} AS cut_r FROM c"
        for at, txt, left, right in (("la", "lt", "la > 0", "false"), ("en", "rt", "false", "cut")))
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
s AS ({spans}),
c AS (SELECT s.row, kind || ':' || lower(value) AS entity, en, greatest(0, st - {REACH}) AS la, substr(text, greatest(0, st - {REACH}) + 1, st - greatest(0, st - {REACH})) AS lt,
             substr(text, en + 1, least(length(text), en + {REACH}) - en) AS rt, least(length(text), en + {REACH}) < length(text) AS cut,
             substr(text, greatest(0, st - {REACH}) + 1, st - greatest(0, st - {REACH})) || chr(1) || substr(text, en + 1, least(length(text), en + {REACH}) - en) AS context
      FROM s JOIN d USING (row)),
w AS ({sides}),
x AS (SELECT row, entity, context, off, win, cut_l, cut_r, m, g, unnest(range(1, len(m) + 1)) AS i
      FROM (SELECT *, regexp_extract_all(win, '{word}') AS m, regexp_split_to_array(win, '{word}') AS g FROM w)),
y AS (SELECT row, entity, context, lower(m[i]) AS term, off + {place} AS a, off + {place} + length(m[i]) AS b, off, length(win) AS n, cut_l, cut_r FROM x),
beside AS (SELECT * FROM y WHERE NOT (cut_l AND a = off) AND NOT (cut_r AND b = off + n)
           AND NOT EXISTS (SELECT 1 FROM s WHERE s.row = y.row AND s.st < y.b AND y.a < s.en)),
pairs AS (SELECT entity, term, count(DISTINCT row) AS joint FROM beside GROUP BY entity, term HAVING count(DISTINCT context) >= {CONTEXTS}),
nt AS (SELECT term, count(*) AS n FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(text), '{word}'))) AS term FROM d) GROUP BY term),
ne AS (SELECT entity, count(DISTINCT row) AS n FROM beside GROUP BY entity),
telling AS (SELECT entity, term FROM pairs JOIN nt USING (term) JOIN ne USING (entity)
            WHERE joint / greatest(nt.n, joint) >= pow(ne.n / (SELECT count(*) FROM d), CAST({1 - ALPHA!r} AS DOUBLE))),
marked AS (SELECT row, string_agg('term:' || a || ':' || b, ',' ORDER BY a, b) AS terms
           FROM (SELECT DISTINCT row, a, b FROM beside JOIN telling USING (entity, term)) GROUP BY row),
base AS (SELECT row, string_agg(kind || ':' || st || ':' || en, ',' ORDER BY ko, st) AS spans, {", ".join(f"sum(CASE WHEN kind = '{k}' THEN 1 ELSE 0 END) AS n_{k}" for k in KINDS)} FROM s GROUP BY row)
SELECT doc_id, {", ".join(f"CAST(coalesce(n_{k}, 0) AS BIGINT) AS n_{k}" for k in KINDS)}, sha256(coalesce(base.spans, '')) AS base_sha256,
       concat_ws(',', base.spans, terms) AS spans
FROM d LEFT JOIN base USING (row) LEFT JOIN marked USING (row)"""


ORACLE = _oracle()
