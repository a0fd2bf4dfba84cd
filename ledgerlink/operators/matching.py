"""Candidate lists, choice among candidates, rating, and the match pipeline
(M5, M6, M7, M13, J2).

Expensive work runs once per *distinct* text and is joined back to every row
(Catalyst will not do this by itself). Repeated texts are the skew of this
workload: the distinct side is small and broadcast when its size allows, and
the join-back otherwise relies on AQE's skew-join split.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlink.functions import text as TX
from ledgerlink.functions.cols import c, round_half_away
from ledgerlink.operators.similarity import RANK_DECIMALS, topk_cosine
from ledgerlink.session import bounded_broadcast, materialize

DISTINCT_BROADCAST_MAX_ROWS = 2_000_000


def join_back(rows: DataFrame, per_text: DataFrame, key: str, how: str = "inner",
              stage: str | None = None) -> DataFrame:
    """Attach per-distinct-text results to every row, taking only
    the result's new columns (no ``_unique`` copies).

    With ``stage``, the per-text result is first written to the shared
    checkpoint folder (the pipeline's stage), so the size check and the join
    read it instead of recomputing the expensive work behind it."""
    new = [x for x in per_text.columns if x == key or x not in rows.columns]
    side = per_text.select(*[c(x) for x in new])
    if stage:
        side = materialize(side, stage)
    return rows.join(bounded_broadcast(side, DISTINCT_BROADCAST_MAX_ROWS), key, how)


def candidates_array(topk: DataFrame, catalogue: DataFrame | None = None,
                     t_id: str = "t_id", t_text: str | None = None) -> DataFrame:
    """Per query, the parallel lists of candidate ids, texts, scores in
    rank order (one row per query; bounded by N)."""
    x = topk
    if catalogue is not None and t_text:
        x = x.join(catalogue.select(c(t_id).alias("t_id"), c(t_text).alias("t_text")), "t_id", "left")
    fields = ["rank", "t_id", "similarity"] + (["t_text"] if "t_text" in x.columns else [])
    g = x.groupBy("q_id").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("_c"))
    lists = {"cand_ids": "t_id", "cand_scores": "similarity", "cand_texts": "t_text"}
    return g.select("q_id", *[F.col(f"_c.{field}").alias(name) for name, field in lists.items() if field in fields])


def jaccard(a: Column, b: Column) -> Column:
    """Token-set overlap |a ∩ b| / |a ∪ b| (0 for two empty sets)."""
    inter = F.size(F.array_intersect(a, b))
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(inter / union)


def choose_match(scored: DataFrame, w_cosine: float, w_overlap: float, w_breadth: float,
                 min_score: float | None = None, overlap: Column | None = None,
                 breadth: Column | None = None) -> DataFrame:
    """M6: one choice per query among its candidates.

    score = w_cosine * similarity + w_overlap * overlap + w_breadth * breadth,
    best score wins, lower catalogue id on ties. With ``min_score`` a query whose
    best score is lower keeps a row with null choice (unmatched, not dropped).
    ``scored`` is the long candidate table ``(q_id, rank, t_id, similarity, ...)``.
    """
    ov = overlap if overlap is not None else F.lit(0.0)
    br = breadth if breadth is not None else F.lit(0.0)
    s = (F.lit(w_cosine) * F.col("similarity") + F.lit(w_overlap) * ov + F.lit(w_breadth) * br)
    x = scored.withColumn("score", s)
    w = Window.partitionBy("q_id").orderBy(F.desc(round_half_away(F.col("score"), RANK_DECIMALS)),
                                           F.asc("t_id"))
    best = x.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")
    if min_score is not None:
        ok = F.col("score") >= F.lit(min_score)
        best = best.select("q_id", *[F.when(ok, F.col(x)).alias(x) for x in best.columns if x != "q_id"])
    return best


def rating(score: Column, buckets: int = 5) -> Column:
    """M7: 1-5 rating of a match score, rounded as scores are for ranking, so that
    0.8 is one rating however it was added up; a score of 1.0 is 5, not 6, and one
    below 0 is 1; no score, no rating (``least`` alone would skip the null)."""
    r = F.greatest(F.lit(1), F.least(F.width_bucket(round_half_away(score, RANK_DECIMALS), F.lit(0.0), F.lit(1.0), F.lit(buckets)), F.lit(buckets)))
    return F.when(score.isNotNull(), r)


def flag_mismatches(choices: DataFrame, score_col: str = "score", flag_at: int = 1) -> DataFrame:
    """M7: ``Rating`` and ``Flag`` (rating == 1); unmatched rows get a null
    rating and a false flag (Q11)."""
    r = rating(c(score_col))
    return (choices.withColumn("Rating", r.cast("long"))
            .withColumn("Flag", F.coalesce(F.col("Rating") == flag_at, F.lit(False))))


def match_pipeline(rows: DataFrame, text_col: str, catalogue: DataFrame, cat_id: str,
                   cat_text: str, embed: Callable[[Column], Column], top_n: int,
                   w_cosine: float, w_overlap: float, w_breadth: float = 0.0,
                   breadth_col: str | None = None, min_score: float | None = None,
                   mode: str = "blocked") -> DataFrame:
    """Distinct texts -> vectors -> top-N -> choice -> join back.

    ``embed`` maps a text column to an ``array<double>`` column (JVM-side, e.g.
    ``text.char_profile``; see ``embed.py`` for model-backed embedders).
    Returns every input row with ``match_id``, ``match_similarity``, ``match_score``.

    Vectors of the distinct texts and of the catalogue are stored: the search
    reads them several times, and its filter on vectors would otherwise be pushed
    below the distinct texts and embed every row.
    """
    # the distinct text is its own (collision-free) query id
    uniq = rows.select(c(text_col).alias("_text")).where(F.col("_text").isNotNull()).distinct()
    qv = materialize(uniq.select(F.col("_text").alias("_qid"), embed(F.col("_text")).alias("_vec")), "text-vectors")
    catalogue = materialize(catalogue.withColumn("_vec", embed(c(cat_text))), "catalogue-vectors")
    cv = catalogue.select(c(cat_id).alias("_tid"), "_vec")
    top = topk_cosine(qv, cv, top_n, "_qid", "_vec", "_tid", "_vec", mode=mode)
    # features for the choice: token overlap with the catalogue text, breadth
    feats = catalogue.select(c(cat_id).alias("t_id"), TX.tokens(c(cat_text)).alias("_ttok"),
                             (c(breadth_col).cast("double") if breadth_col else F.lit(0.0)).alias("_br"))
    qt = qv.select(F.col("_qid").alias("q_id"), TX.tokens(F.col("_qid")).alias("_qtok"))
    scored = top.join(qt, "q_id").join(feats, "t_id")
    best = choose_match(scored, w_cosine, w_overlap, w_breadth, min_score,
                        overlap=jaccard(F.col("_qtok"), F.col("_ttok")), breadth=F.col("_br"))
    per_text = best.select(F.col("q_id").alias(text_col), F.col("t_id").alias("match_id"),
                           F.col("similarity").alias("match_similarity"),
                           F.col("score").alias("match_score"))
    return join_back(rows, per_text, text_col, "left", stage="matches-per-text")


def user_choose(candidates: DataFrame, fn: Callable[[pd.DataFrame], pd.Series]) -> DataFrame:
    """M6 hook: a user chooser (a local model, rules, ...) applied to Arrow
    batches of ``candidates_array`` rows (``q_id``, ``cand_ids``, optional
    ``cand_texts``/``cand_scores``). ``fn`` returns one chosen id per row.

    Ids keep their type. An answer that is not among the row's candidates leaves
    the row unmatched (null). A batch whose call raises is tried again in halves,
    so only the rows that fail by themselves stay unmatched.
    """
    def ask(pdf: pd.DataFrame) -> list:
        try:
            return list(fn(pdf))
        except Exception:
            if len(pdf) < 2:
                return [None] * len(pdf)
            half = len(pdf) // 2
            return ask(pdf.iloc[:half]) + ask(pdf.iloc[half:])

    def run(batches):
        for pdf in batches:
            chosen = [next((i for i in ids if a is not None and str(i) == str(a)), None)
                      for a, ids in zip(ask(pdf), pdf["cand_ids"])]
            yield pd.DataFrame({"q_id": pdf["q_id"], "chosen_id": pd.Series(chosen, index=pdf.index, dtype=object)})

    q_type = candidates.schema["q_id"].dataType.simpleString()
    c_type = candidates.schema["cand_ids"].dataType.elementType.simpleString()
    return candidates.mapInPandas(run, f"q_id {q_type}, chosen_id {c_type}")
