"""Choosing among candidates by an outside chooser, in rounds.

A chooser is any function of a batch of rows (text, candidate ids, their texts and
scores) that returns one candidate id a row: a language model, a service, rules.
It may fail. Rows are sent in batches that keep to a token budget (W4); the rows
of batches that failed, and those whose answer is none of their candidates, are
what the next round sends, in batches of half the budget, and the last round
sends each by itself. So one bad row costs the rows beside it a round, not their
answers. Every round is a stage; with a folder it is committed, and a run that is
killed or repeated asks again only what it has no committed answer for.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.functions import text as TX
from ledgerlink.functions.cols import c
from ledgerlink.operators import embed as EM
from ledgerlink.operators.matching import candidates_array, join_back
from ledgerlink.operators.relational import token_budget_batches
from ledgerlink.operators.similarity import topk_cosine
from ledgerlink.operators.stages import StageStore
from ledgerlink.session import materialize


def choose_in_rounds(candidates: DataFrame, fn: Callable[[pd.DataFrame], list], budget: int, rounds: int = 4,
                     folder: str | None = None, version: str = "") -> tuple[DataFrame, DataFrame]:
    """(answers (q_id, chosen_id); attempts (round, q_id, batch_id, chosen_id, error)).

    ``candidates`` are rows (q_id, text, cand_ids, cand_texts, cand_scores) with
    unique ids. A row's tokens are the words of its text and candidate texts. All
    rows have an answer or an error of each round in which they were asked; rows
    that fail in the last round have no answer."""
    spark = candidates.sparkSession
    store = StageStore(spark, folder) if folder else None
    words = F.aggregate("cand_texts", F.lit(0).cast("long"), lambda n, t: n + F.coalesce(TX.word_count(t), F.lit(0)))
    pending = materialize(candidates.withColumn("tokens", F.coalesce(TX.word_count(F.col("text")), F.lit(0)) + words + 1), "to-choose")
    id_type, q_type = candidates.schema["cand_ids"].dataType.elementType.simpleString(), candidates.schema["q_id"].dataType.simpleString()
    schema = f"q_id {q_type}, batch_id long, chosen_id {id_type}, error string"

    def ask(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("q_id").reset_index(drop=True)
        try:
            answers, error = list(fn(pdf.drop(columns=["batch_id", "tokens"]))), None
            if len(answers) != len(pdf):
                raise ValueError(f"{len(answers)} answers for {len(pdf)} rows")
        except Exception as e:
            answers, error = [None] * len(pdf), f"{type(e).__name__}: {e}"
        chosen = [next((i for i in ids if a is not None and str(i) == str(a)), None) for a, ids in zip(answers, pdf["cand_ids"])]
        errors = [error if error is not None else None if x is not None else "not a candidate" for x in chosen]
        return pd.DataFrame({"q_id": pdf["q_id"], "batch_id": pdf["batch_id"], "chosen_id": pd.Series(chosen, dtype=object), "error": pd.Series(errors, dtype=object)})

    def one_round(rows: DataFrame, tokens: int) -> DataFrame:
        batch = token_budget_batches(rows.select("q_id", "tokens"), ["q_id"], "tokens", tokens).select("q_id", "batch_id")
        return rows.join(batch, "q_id").groupBy("batch_id").applyInPandas(ask, schema)

    attempts = None
    for r in range(rounds):
        if pending.isEmpty():
            break
        tokens = 1 if r == rounds - 1 else max(1, budget >> r)
        if store:
            done = store.reuse("answers", [pending], lambda p: one_round(p, tokens), version, {"tokens": tokens})
        else:
            done = materialize(one_round(pending, tokens), "answers")
        this = done.withColumn("round", F.lit(r))
        attempts = this if attempts is None else attempts.unionByName(this)
        pending = materialize(pending.join(done.where("error IS NULL").select("q_id"), "q_id", "left_anti"), "to-choose")
    if attempts is None:
        attempts = spark.createDataFrame([], schema).withColumn("round", F.lit(0))
    return attempts.where("error IS NULL").select("q_id", "chosen_id"), attempts.select("round", "q_id", "batch_id", "chosen_id", "error")


def weighted_chooser(w_cosine: float, w_overlap: float, w_breadth: float) -> Callable[[pd.DataFrame], list]:
    """A chooser by rules: similarity, shared words, and a preference for broad
    options, those with few words. The best weighted sum wins, the lower id on
    ties."""
    word = re.compile(r"[^\W\d_]+")

    def choose(pdf: pd.DataFrame) -> list:
        out = []
        for text, ids, options, scores in zip(pdf["text"], pdf["cand_ids"], pdf["cand_texts"], pdf["cand_scores"]):
            own, best = set(word.findall((text or "").lower())), None
            for i, option, score in zip(ids, options, scores):
                terms = set(word.findall((option or "").lower()))
                overlap = len(own & terms) / len(own | terms) if own | terms else 0.0
                value = w_cosine * score + w_overlap * overlap + w_breadth * (1.0 / len(terms) if terms else 0.0)
                if best is None or (-round(value, 9), i) < best:
                    best = (-round(value, 9), i)
            out.append(best[1] if best else None)
        return out

    return choose


def match_with_chooser(rows: DataFrame, text_col: str, catalogue: DataFrame, cat_id: str, cat_text: str,
                       embed: Callable[[DataFrame], DataFrame], choose: Callable[[pd.DataFrame], list], top_n: int, budget: int,
                       folder: str | None = None, model: str = "", version: str = "", rounds: int = 4) -> DataFrame:
    """Every row with ``match_id`` and ``match_similarity``.

    Distinct texts are named by their hash, embedded with the catalogue's texts
    by ``embed`` (a table of texts to (text, embedding), see ``embed.py``), given
    their ``top_n`` candidates with texts and scores, and sent to ``choose`` in
    rounds. With a ``folder`` vectors and answers are kept there by model and
    version. Rows without a text or an answer have nulls. Catalogue ids must be
    unique."""
    def vectors(texts: DataFrame) -> DataFrame:
        return EM.embed_cached(texts, f"{folder}/vectors", model, embed, version) if folder else embed(texts)

    keyed = materialize(rows.withColumn("_h", F.md5(c(text_col))), "rows-to-match")
    # repeats go before the shuffle: no row's text is sent to find the distinct ones
    texts = keyed.where(F.col("_h").isNotNull()).select(F.col("_h").alias("q_id"), c(text_col).alias("text")).distinct()
    texts = materialize(texts, "texts-to-match")
    options = materialize(catalogue.select(c(cat_id).alias("t_id"), c(cat_text).alias("t_text")), "options")
    of_options = vectors(options.select(F.col("t_text").alias("text")).where(F.col("text").isNotNull()).distinct())
    cv = options.join(of_options.select(F.md5("text").alias("_o"), "embedding"), F.md5("t_text") == F.col("_o")).select("t_id", "embedding")
    qv = vectors(texts.select("text")).select(F.md5("text").alias("q_id"), "embedding")
    top = materialize(topk_cosine(qv, cv, top_n, "q_id", "embedding", "t_id", "embedding"), "candidates")
    found = candidates_array(top, options, "t_id", "t_text").join(texts, "q_id").select("q_id", "text", "cand_ids", "cand_texts", "cand_scores")
    answers, _ = choose_in_rounds(found, choose, budget, rounds, folder, version)
    per_text = answers.join(top.select("q_id", F.col("t_id").alias("chosen_id"), "similarity"), ["q_id", "chosen_id"]).select(
        F.col("q_id").alias("_h"), F.col("chosen_id").alias("match_id"), F.col("similarity").alias("match_similarity"))
    return join_back(keyed, per_text, "_h", "left", stage="matches-per-text").drop("_h")
