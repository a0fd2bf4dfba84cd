"""Column translation by glossary, once per distinct text (M8).

The reference translates columns with a local model in 10 processes x batches
of 10 and keeps the source as ``"<col> original"``. Here the *data flow* is
kept (distinct texts -> translate -> join back, both columns out) and the
translator is a glossary table:

* small glossary (bounded, checked): a literal ``map`` looked up per token
  inside ``transform`` -- no explode, no shuffle, whole-stage JVM code;
* large glossary: tokens exploded with their position, broadcast-or-shuffle
  left join, reassembled in order per text (``collect_list`` per text is
  bounded by one text's length).

``translate_phrases`` takes sources of several words as well, by leftmost-longest
matching, with one plan for every size of glossary.

Unknown tokens are kept as they are. A user model can be plugged in through
``user_translate`` (``mapInPandas`` over Arrow batches of distinct texts).
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.functions.cols import c
from ledgerlink.session import MAX_BROADCAST_BYTES, bounded_broadcast, bounded_size, materialize

# a literal map is scanned linearly per lookup, so it only serves small
# glossaries; larger ones go through the (broadcast) join path
MAP_LOOKUP_MAX_ENTRIES = 256


def _translate_with_map(col, glossary: dict[str, str]):
    keys = list(glossary)
    m = F.map_from_arrays(F.array(*[F.lit(k) for k in keys]),
                          F.array(*[F.lit(glossary[k]) for k in keys]))
    toks = F.split(col, " ")
    return F.array_join(F.transform(toks, lambda t: F.coalesce(F.try_element_at(m, F.lower(t)), t)), " ")


def _translate_with_join(texts: DataFrame, glossary: DataFrame) -> DataFrame:
    ex = texts.select("_text", F.posexplode(F.split("_text", " ")).alias("_pos", "_tok"))
    g = glossary.select(F.col("source").alias("_key"), F.col("target").alias("_tr"))
    j = ex.join(g, F.lower(F.col("_tok")) == F.col("_key"), "left")
    out = j.groupBy("_text").agg(F.sort_array(F.collect_list(
        F.struct("_pos", F.coalesce("_tr", "_tok").alias("_w")))).alias("_s"))
    return out.select("_text", F.array_join(F.transform("_s", lambda s: s["_w"]), " ").alias("_translated"))


def translate_columns(df: DataFrame, cols: list[str], glossary: DataFrame,
                      max_map_entries: int = MAP_LOOKUP_MAX_ENTRIES) -> DataFrame:
    """Translate ``cols`` token by token; the source text moves to
    ``"<col> original"``."""
    # one translation per source (the lowest target), so that both forms give the same text
    glossary = glossary.where(F.col("source").isNotNull()).groupBy("source").agg(F.min("target").alias("target"))
    small = glossary.limit(max_map_entries + 1).collect() if max_map_entries else []
    use_map = 0 < len(small) <= max_map_entries
    gmap = {r["source"]: r["target"] for r in sorted(small, key=lambda r: r["source"])} if use_map else None
    out = df
    if use_map:                                  # a row expression: nothing to join back
        for col in cols:
            out = out.withColumnRenamed(col, f"{col} original").withColumn(col, _translate_with_map(c(f"{col} original"), gmap))
        return out
    for col in cols:
        uniq = df.select(c(col).alias("_text")).where(F.col("_text").isNotNull()).distinct()
        tr = _translate_with_join(uniq, glossary)
        out = (out.withColumnRenamed(col, f"{col} original")
               .join(tr.withColumnRenamed("_text", f"{col} original"), f"{col} original", "left")
               .withColumnRenamed("_translated", col))
    return out


#: Copies of a glossary that is too large to broadcast, so that a run of words
#: that many texts share meets it in so many places.
SALTS = 16
#: Sources that begin with one word, up to which the runs at that word are compared with each.
MOST_OF_HEAD = 32


def _apply_phrases(text: str, hits: list) -> str:
    """The text with its matches replaced: of those (position, words, target) that
    overlap the leftmost, of those at one position the longest counts."""
    tokens, out, at = text.split(" "), [], 0
    for pos, words, target in sorted(hits, key=lambda h: (h[0], -h[1])):
        if pos >= at:
            out += tokens[at:pos]
            out.append(target)
            at = pos + words
    return " ".join(out + tokens[at:])


def phrase_matches(texts: DataFrame, glossary: DataFrame, max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """(_h, pos, words, target): every run of words of the texts (_h, _text) that is a
    source of the glossary (lower case, words divided by one blank).

    With a small glossary each word meets the sources that begin with it, and only
    those are compared with the run there. Otherwise a text gives one narrow row a
    word and phrase length, with the 128-bit hash of that run; runs and sources
    meet on the hash. The lengths are those that the glossary has."""
    lower = F.lower("source")
    entries = (glossary.where(F.col("source").isNotNull() & F.col("target").isNotNull()).groupBy(lower.alias("source")).agg(F.min("target").alias("target")))
    entries = materialize(entries.select("source", F.md5("source").alias("_run"), "target", F.size(F.split("source", " ")).alias("words")), "phrases")
    lengths = sorted(r["words"] for r in entries.select("words").distinct().collect())        # as many as lengths occur
    if not lengths:
        return texts.select("_h", F.lit(0).alias("pos"), F.lit(0).alias("words"), F.lit("").alias("target")).limit(0)
    tokens = texts.select("_h", F.split(F.lower("_text"), " ").alias("_w"))
    n_rows, n_bytes = bounded_size(entries, max_broadcast_rows)
    small = n_rows <= max_broadcast_rows and n_bytes <= MAX_BROADCAST_BYTES
    heads = entries.select(F.get(F.split("source", " "), F.lit(0)).alias("_head"), "source", "target", "words")
    if small and heads.groupBy("_head").count().agg(F.max("count")).first()[0] <= MOST_OF_HEAD:
        same = F.array_join(F.slice("_w", F.col("pos") + 1, F.col("words")), " ") == F.col("source")
        at = tokens.select("_h", "_w", F.posexplode("_w").alias("pos", "_first"))
        return at.join(F.broadcast(heads), (F.col("_first") == F.col("_head")) & same).select("_h", "pos", "words", "target")
    runs = tokens.select("_h", "_w", F.posexplode("_w").alias("pos", "_first")).select(
        "_h", "pos", F.explode(F.array(*[F.when(F.col("pos") + n <= F.size("_w"), F.struct(
            F.lit(n).alias("words"), F.md5(F.array_join(F.slice("_w", F.col("pos") + 1, n), " ")).alias("_run"))) for n in lengths])).alias("_r"))
    runs = runs.where(F.col("_r").isNotNull()).select("_h", "pos", "_r.words", "_r._run")
    entries = entries.drop("source")
    if n_rows <= max_broadcast_rows:
        return runs.join(bounded_broadcast(entries, max_broadcast_rows), ["_run", "words"]).select("_h", "pos", "words", "target")
    salted = entries.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    runs = runs.withColumn("_salt", F.pmod(F.xxhash64("_h", "pos"), F.lit(SALTS)).cast("int"))
    return runs.join(salted, ["_run", "words", "_salt"]).select("_h", "pos", "words", "target")


def translate_phrases(df: DataFrame, cols: list[str], glossary: DataFrame, max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """M8: translate ``cols`` by a glossary (source, target) of words and phrases; the
    source text moves to ``"<col> original"``.

    Words are what lies between blanks, whatever their case. Of matches that
    overlap the leftmost counts, of those that begin at one word the longest. A
    source that is there twice has its lowest target. Each distinct text is
    translated once; texts meet their matches and rows their texts by hash."""
    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"_h": pdf["_h"], "_new": [_apply_phrases(t, [(r["pos"], r["words"], r["target"]) for r in hits])
                                                          for t, hits in zip(pdf["_text"], pdf["_hits"])]})

    out = df
    for col in cols:
        rows = materialize(out.withColumnRenamed(col, f"{col} original").withColumn("_h", F.md5(c(f"{col} original")))
                           .withColumn("_row", F.monotonically_increasing_id()), "rows-to-translate")
        first = rows.where(F.col("_h").isNotNull()).groupBy("_h").agg(F.min("_row").alias("_row"))
        texts = materialize(rows.select("_row", c(f"{col} original").alias("_text")).join(first, "_row").select("_h", "_text"), "texts-to-translate")
        hits = phrase_matches(texts, glossary, max_broadcast_rows)
        # at most a text's words for a row
        hits = hits.groupBy("_h").agg(F.collect_list(F.struct("pos", "words", "target")).alias("_hits"))
        new = materialize(texts.join(hits, "_h").mapInPandas(run, "_h string, _new string"), "translated-texts")
        out = rows.join(new, "_h", "left").withColumn(col, F.coalesce("_new", c(f"{col} original"))).drop("_h", "_row", "_new")
    return out


def user_translate(df: DataFrame, col: str, fn: Callable[[pd.Series], pd.Series]) -> DataFrame:
    """Translate distinct texts of ``col`` with a user function over Arrow
    batches, join back; the source text moves to ``"<col> original"``."""
    uniq = df.select(c(col).alias("_text")).where(F.col("_text").isNotNull()).distinct()

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"_text": pdf["_text"], "_translated": fn(pdf["_text"]).astype(str)})

    tr = uniq.mapInPandas(run, "_text string, _translated string")
    return (df.withColumnRenamed(col, f"{col} original")
            .join(tr.withColumnRenamed("_text", f"{col} original"), f"{col} original", "left")
            .withColumnRenamed("_translated", col))
