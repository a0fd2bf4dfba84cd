"""Mixing documents to target domain weights by soft membership.

1. A naive Bayes classifier over hashed words is fitted on labelled rows (at most
   ``SAMPLE``, in the order of a hash of the id). Its table has ``BUCKETS`` rows
   and one log-odds column per domain, whatever the size of the corpus.
2. Every document gets domain posteriors from all its words. The evidence of a
   long text counts as ``EVIDENCE`` words, so memberships stay soft.
3. Nonnegative document rates are fitted by projected-gradient least squares:
   with n_i tokens and posteriors P_ik, the expected tokens of domain k are
   sum_i r_i n_i P_ik. Starting at r = 1, each step is
   r <- max(0, r - P inv(G) residual) with G = sum_i n_i P_i P_i', the gradient of
   the residual's norm in the metric that makes the step length 1. A step is one
   aggregate over the stored posteriors; what returns to the driver is one number
   per domain, and rates are an expression of the steps' multipliers, so no state
   per document is kept between steps.

All of it is DataFrame functions: the corpus is read once, row by row, and only
(id, tokens, posteriors) are stored. Nothing is shuffled by key, so a source
that holds a third of all rows is no special case.

Defined cases: null and empty texts have 0 tokens and the prior as posterior; a
target domain that nobody is labelled with, or a weight below 0, is an error;
labelled domains without a target keep the share of the tokens that they have,
and the targets share the rest. Without documents the result is
empty; without labelled rows there is one rate, 1, for all. Repeated rows stay.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm.common import Stages, ascii_lower, table

BUCKETS = 4096
SAMPLE = 20_000
EVIDENCE = 30
STEPS = 60
TOLERANCE = 1e-9

#: Weights of the languages in the registered query and the pipeline.
TARGETS = {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}


def words(text: Column) -> Column:
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+", -1)
    return F.filter(parts, lambda w: w != "")


def codes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))


def doubles(values: list[float]) -> Column:
    return F.expr("array(" + ",".join(f"{v!r}D" for v in values) + ")")


def fit_domains(labelled: DataFrame) -> tuple[list[str], list[float], list[list[float]]]:
    """Domains, log priors and per domain the log likelihood of each bucket."""
    seen = labelled.filter("domain is not null").select("domain", codes(F.col("text")).alias("codes"))
    with Stages(seen.sparkSession) as stages:
        seen = stages.write(seen, "labelled")
        docs = {r[0]: r[1] for r in seen.groupBy("domain").count().collect()}                  # a row per domain
        counts = seen.select("domain", F.explode("codes").alias("code")).groupBy("domain", "code").count().collect()   # BUCKETS per domain
    domains = sorted(docs)
    like = {d: [1.0] * BUCKETS for d in domains}
    for domain, code, n in counts:
        like[domain][code] += n
    for d in domains:
        total = sum(like[d])
        like[d] = [math.log(x / total) for x in like[d]]
    return domains, [math.log(docs[d] / sum(docs.values())) for d in domains], [like[d] for d in domains]


def sum_of(odds: Column) -> Column:
    """Sum of the entries of ``odds`` that ``codes`` names."""
    return F.aggregate("codes", F.lit(0.0), lambda s, c: s + F.get(odds, c))


def posteriors(docs: DataFrame, model: tuple[list[str], list[float], list[list[float]]], columns: tuple = ("doc_id",)) -> DataFrame:
    """doc_id (or the columns given), n_tokens and ``p``, one posterior per domain, for every row."""
    domains, prior, like = model
    rows = docs.select(*columns, codes(F.col("text")).alias("codes"))
    base = like[0]
    n = F.size("codes")
    share = F.when(n > 0, F.least(F.lit(1.0), F.lit(float(EVIDENCE)) / n)).otherwise(F.lit(0.0))
    sums = [F.lit(0.0)]
    for other in like[1:]:                       # log odds against the first domain
        sums.append(sum_of(doubles([a - b for a, b in zip(other, base)])))
    rows = rows.select(*columns, n.cast("long").alias("n_tokens"), F.array(*[F.lit(q) + share * s for q, s in zip(prior, sums)]).alias("z"))
    rows = rows.withColumn("e", F.transform("z", lambda x: F.exp(x - F.array_max("z"))))
    return rows.select(*columns, "n_tokens", F.transform("e", lambda x: x / F.aggregate("e", F.lit(0.0), lambda s, y: s + y)).alias("p"))


def rate_column(multipliers: list[list[float]]) -> Column:
    """The rates after the given steps, as an expression of ``p``."""
    r = F.lit(1.0)
    for m in multipliers:
        step = sum((F.get("p", k) * F.lit(float(x)) for k, x in enumerate(m)), F.lit(0.0))
        r = F.greatest(F.lit(0.0), r - step)
    return r


def shares(weights: list[float | None], total: np.ndarray) -> np.ndarray:
    """Target shares of the tokens: domains without a weight keep theirs, the others share the rest."""
    own = total / total.sum()
    free = np.array([w is None for w in weights])
    if own[~free].sum() == 0:                    # nothing to share out
        return own
    w = np.array([0.0 if x is None else x for x in weights])
    return np.where(free, own, w / w.sum() * (1 - own[free].sum()))


def fit_rates(members: DataFrame, weights: list[float | None], budget: float | None = None, steps: int = STEPS) -> list[list[float]]:
    """The multipliers of the gradient steps. Without a budget the token total is
    the smallest at which no domain has to shrink."""
    k = len(weights)
    n = F.col("n_tokens")
    cells = [(i, j) for i in range(k) for j in range(i, k)]
    first = members.agg(*[F.sum(n * F.get("p", i)).alias(f"t{i}") for i in range(k)],
                        *[F.sum(n * F.get("p", i) * F.get("p", j)).alias(f"g{i}_{j}") for i, j in cells]).first()
    total = np.array([first[f"t{i}"] or 0.0 for i in range(k)])
    if not total.sum():
        return []
    g = np.zeros((k, k))
    for i, j in cells:
        g[i, j] = g[j, i] = first[f"g{i}_{j}"] or 0.0
    inverse = np.linalg.pinv(g, rcond=1e-12)
    w = shares(weights, total)
    if budget is None:
        budget = max(t / x for t, x in zip(total, w) if x > 0)
    multipliers: list[list[float]] = []
    residual = total - budget * w
    while len(multipliers) < steps and np.abs(residual).max() > TOLERANCE * budget:
        multipliers.append((inverse @ residual).tolist())
        r = rate_column(multipliers)
        got = members.agg(*[F.sum(r * n * F.get("p", i)).alias(f"t{i}") for i in range(k)]).first()
        residual = np.array([got[i] for i in range(k)]) - budget * w
    return multipliers


def _weights(domains: list[str], targets: dict[str, float]) -> list[float | None]:
    """The targets in the order of the domains; None where a domain has none."""
    given = [float(w) for w in targets.values()]
    if min(given, default=0.0) < 0 or not sum(given) or set(targets) - set(domains):
        raise ValueError(f"targets {targets} do not fit the labelled domains {domains}")
    return [float(targets[d]) if d in targets else None for d in domains]


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], budget: float | None = None) -> DataFrame:
    """doc_id, n_tokens, domain, posterior, rate of every row of ``docs``; the
    domain is the likeliest one (the first in order of name, of equal ones)."""
    model = fit_domains(labelled)
    domains = model[0]
    if not domains:
        return docs.select("doc_id", F.size(words(F.col("text"))).cast("long").alias("n_tokens"), F.lit(None).cast("string").alias("domain"),
                           F.lit(None).cast("double").alias("posterior"), F.lit(1.0).alias("rate"))
    weights = _weights(domains, targets)
    with Stages(docs.sparkSession) as stages:
        members = stages.write(posteriors(docs, model), "members", keep=True)
        multipliers = fit_rates(members, weights, budget)
    names = F.array(*[F.lit(d) for d in domains])
    best = (F.array_position(F.col("p"), F.array_max("p")) - 1).cast("int")
    return members.select("doc_id", "n_tokens", F.get(names, best).alias("domain"), F.array_max("p").alias("posterior"), rate_column(multipliers).alias("rate"))


def labelled_rows(docs: DataFrame, labels: DataFrame, domain: str, sample: int = SAMPLE) -> DataFrame:
    """(text, domain) of at most ``sample`` rows that the label table names."""
    ids = labels.select("doc_id").filter("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    return docs.select("doc_id", "text", F.col(domain).cast("string").alias("domain")).join(F.broadcast(ids), "doc_id", "left_semi").select("text", "domain")


def copies(rate: Column, key: Column) -> Column:
    """Whole copies with the expected value ``rate``, fixed by a hash of the key."""
    share = F.pmod(F.xxhash64(key, F.lit("mixing")), F.lit(1 << 32)) / float(1 << 32)
    return (F.floor(rate) + F.when(share < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def mix_documents(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], budget: float | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, each as many times as its rate says: whole
    copies, and one more with the remaining share as probability, fixed by a hash of
    the row. With the default budget no domain shrinks and no row is left out: rates
    are 1 or more."""
    model = fit_domains(labelled)
    if not model[0]:
        return docs
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    weights = _weights(model[0], targets)
    with Stages(docs.sparkSession) as stages:
        members = stages.write(posteriors(docs.select(row, "text"), model, ("row",)), "members", keep=True)
        multipliers = fit_rates(members, weights, budget)
    rate = rate_column(multipliers)
    if budget is None:
        rate = F.greatest(F.lit(1.0), rate)
    times = copies(rate, F.xxhash64("row.doc_id", "row.text"))
    return members.withColumn("times", times).filter("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix(docs, labelled_rows(docs, table(spark, sf_dir, "labels"), "lang"), TARGETS)
