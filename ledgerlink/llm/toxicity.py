"""Toxicity scores from averaged subword embeddings and a linear softmax.

A text is the bag of its character n-grams (``GRAMS`` bytes, inside words, with
the word's boundaries), hashed into ``BUCKETS``. Its vector is the mean of the
embeddings of its n-grams, and a linear softmax gives the two class
probabilities. Embeddings and softmax start at random and are trained jointly by
gradient descent in numpy; a misspelling shares most n-grams with the word it hides.

The model is fitted on a bounded sample: at most ``SAMPLE`` labelled rows of
each class, in the order of a hash of the id. Their n-gram counts are computed
where the rows lie; one task fits the model, whose size is fixed. Scoring is one
pass over whole texts without a shuffle: since vector and softmax are linear,
an n-gram adds one number.

Defined cases: null and empty texts have no n-grams and get the model's bias;
rows with a null label, or with a null id, teach nothing; a null id is not held
out. Without rows of both classes every score is 0; where no n-gram tells the
classes apart, 0.5. Extra columns are ignored,
repeated rows stay.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm.common import Stages, doc_hash_mod, frugal, give_back, table

GRAMS = (3, 4, 5, 6)
BUCKETS_LOG2 = 18
BUCKETS = 1 << BUCKETS_LOG2
DIM = 8
SAMPLE = 3_000
EPOCHS = 100
SIGMAS = 4.0
RIDGE = 1e-6
CUT = 0.7
#: n-grams without a vector that every bag has besides its own, so that a few words alone decide little.
NEUTRAL = 100
#: Spread of the sample's logits under the random vectors at the start.
START = 0.1
#: How much less a repeated word weighs: 0 is its full count, 1 counts it once.
DAMP = 0.5

_KEEP = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def bags(texts: list[str | None], most_bytes: int = 400_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """For ranges of whole texts: (first, last, start of each text, weight of each
    position, and per n-gram length the buckets and flags of valid positions).
    A word that a text has t times weighs t ** -DAMP each time."""
    clean = [b" " + b" ".join((t or "").lower().encode("utf-8", "surrogatepass").translate(_KEEP).split()) + b" " for t in texts]
    first = 0
    while first < len(clean):
        last, size = first, 0
        while last < len(clean) and (last == first or size + len(clean[last]) <= most_bytes):
            size += len(clean[last])
            last += 1
        flat = np.frombuffer(b"".join(clean[first:last]) + b" " * max(GRAMS), dtype=np.uint8)
        starts = np.cumsum([0] + [len(c) for c in clean[first:last - 1]])
        space = flat == 32
        spaces = np.cumsum(space)

        begin = np.flatnonzero(space[:-1] & ~space[1:]) + 1
        length = np.flatnonzero(~space[:-1] & space[1:]) + 1 - begin
        weight = np.zeros(size, dtype=np.float32)
        if len(begin):
            letters = flat[~space].astype(np.uint64)
            offset = (np.arange(len(letters)) - np.repeat(np.cumsum(length) - length, length)).astype(np.uint64)
            mixed = (letters + np.uint64(1)) * ((offset * np.uint64(2) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            word = np.add.reduceat(mixed, np.cumsum(length) - length)
            text = np.searchsorted(starts, begin, side="right").astype(np.uint64)
            _, same, times = np.unique(word ^ (text * np.uint64(0xD6E8FEB86659FD93)), return_inverse=True, return_counts=True)
            weight[np.flatnonzero(~space[:size]) - 1] = np.repeat((times ** -DAMP)[same], length).astype(np.float32)   # n-grams begin one before
        h = flat[:size].astype(np.uint64)
        grams = []
        for n in range(2, max(GRAMS) + 1):
            h = h * np.uint64(0x100000001B3) + flat[n - 1:n - 1 + size]
            if n in GRAMS:
                inside = spaces[n - 2:n - 2 + size] == spaces[:size]
                grams.append((((h + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BUCKETS_LOG2)).astype(np.int32), inside))
        yield first, last, starts, weight, grams
        first = last


def counts(s: int, e: int, weight: np.ndarray, grams: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, weights) of the bag at positions s to e."""
    g = np.concatenate([b[s:e][ok[s:e]] for b, ok in grams])
    w = np.concatenate([weight[s:e][ok[s:e]] for _, ok in grams])
    index, at = np.unique(g, return_inverse=True)
    return index, np.bincount(at, weights=w, minlength=len(index))


def telling(with1: np.ndarray, with0: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """Flags of the buckets whose shares of the two classes' rows differ clearly."""
    n1, n0 = max(1, n1), max(1, n0)
    share = (with1 + with0 + 1) / (n1 + n0 + 2)
    error = np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))
    return np.abs(with1 / n1 - with0 / n0) >= SIGMAS * error


def fit(index: np.ndarray, value: np.ndarray, lens: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings (BUCKETS x DIM), softmax (2 x DIM) and the softmax's biases (2),
    all from random starts by accelerated gradient descent on all three together.

    Rows are bags: ``lens`` entries of (index, value) each, values summing to less than 1.
    The classes have equal weight. Buckets whose shares of the two classes' rows
    differ by less than ``SIGMAS`` standard errors teach nothing and keep a zero
    vector: most n-grams are rare, and would fit single rows. Values are scaled by
    each bucket's root mean square with a floor, so that frequent n-grams do not
    carry the fit. With two classes the errors of a row are a and -a, so the
    gradient of the embeddings is q (soft[1] - soft[0]) and that of the softmax
    (-q, q) times the embeddings, where q is the bags' sum of a: one pass over
    the entries a step. A step's length follows from the curvature along its
    steepest direction, which grows with both factors."""
    with1 = np.bincount(index, weights=np.repeat(y, lens), minlength=BUCKETS)
    keep = telling(with1, np.bincount(index, minlength=BUCKETS) - with1, y.sum(), len(y) - y.sum())[index]
    if not keep.any():                           # nothing tells the classes apart
        return np.zeros((BUCKETS, DIM)), np.zeros((2, DIM)), np.zeros(2)
    row = np.repeat(np.arange(len(y)), lens)[keep]
    kept, index = np.unique(index[keep], return_inverse=True)
    value = value[keep].astype(np.float64)
    rms = np.sqrt(np.bincount(index, weights=value * value, minlength=len(kept)) / len(y))
    step = 1.0 / (rms + np.sqrt(10.0 / len(y)) * value.mean())
    scaled = value * step[index]
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))

    def times(u: np.ndarray) -> np.ndarray:      # bags times a vector, less its weighted mean
        z = np.bincount(row, weights=scaled * u[index], minlength=len(y))
        return z - weight @ z

    def back(a: np.ndarray) -> np.ndarray:
        a = a - weight * a.sum()
        return np.bincount(index, weights=scaled * a[row], minlength=len(kept))

    rng = np.random.RandomState(seed)
    u = rng.normal(size=len(kept))
    for _ in range(6):                           # the logistic loss bends most along this direction
        u = back(weight * times(u))
        steepest = np.linalg.norm(u)
        u /= max(steepest, 1e-300)

    emb, soft, bias = start(len(kept), rng)
    z = times(emb @ (soft[1] - soft[0]))
    emb *= START / max(np.sqrt(weight @ (z * z)), 1e-300)
    held = ahead = (emb, soft, bias)
    for t in range(epochs):
        emb, soft, bias = ahead
        d = soft[1] - soft[0]
        z = times(emb @ d) + bias[1] - bias[0]
        a = weight * (1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - y)
        q = back(a)
        lr = 1.0 / (0.375 * max(steepest, 1e-12) * (d @ d + 2 * np.linalg.norm(emb.T @ emb, 2)))
        turn = emb.T @ q
        new = (emb - lr * (np.outer(q, d) + RIDGE * emb), soft - lr * np.array([-turn, turn]), bias - 0.5 * np.array([-a.sum(), a.sum()]))
        ahead = tuple(n + t / (t + 3.0) * (n - h) for n, h in zip(new, held))
        held = new
    emb, soft, bias = held
    emb = emb * step[:, None]
    # the mean that ``times`` takes off belongs to the biases
    mean = weight @ np.bincount(row, weights=value * (emb @ (soft[1] - soft[0]))[index], minlength=len(y))
    every = np.zeros((BUCKETS, DIM))
    every[kept] = emb
    return every, soft, bias + 0.5 * np.array([mean, -mean])


def start(buckets: int, rng: np.random.RandomState) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random embeddings and softmax, whose columns are a unit apart, and no biases."""
    soft = rng.normal(size=(2, DIM))
    return rng.normal(size=(buckets, DIM)), soft / np.linalg.norm(soft[1] - soft[0]), np.zeros(2)


def train(texts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Fit on rows (doc_id, text, label 0/1); None without both classes."""
    spark = texts.sparkSession

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for first, last, starts, weight, grams in bags(pdf["text"].tolist()):
                ends = np.append(starts[1:], len(weight))
                out = [counts(s, e, weight, grams) for s, e in zip(starts, ends)]
                yield pd.DataFrame({"label": pdf["label"].iloc[first:last].values, "index": [i.astype("<i4").tobytes() for i, _ in out],
                                    "value": [(n / (n.sum() + NEUTRAL)).astype("<f4").tobytes() for _, n in out]})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, seen = np.zeros(2), np.zeros((2, BUCKETS), dtype=np.int32)
        for pdf in batches:
            for label, index in zip(pdf["label"], pdf["index"]):
                rows[label] += 1
                seen[label, np.frombuffer(index, "<i4")] += 1              # a row has each bucket once
        if rows.sum():
            yield pd.DataFrame({"n0": [rows[0]], "n1": [rows[1]], "seen": [zlib.compress(seen.tobytes(), 1)]})

    def sift(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts = [(np.frombuffer(i, "<i4"), np.frombuffer(v, "<f4")) for i, v in zip(pdf["index"], pdf["value"])]
            flags = [keep[i] for i, _ in parts]
            yield pd.DataFrame({"label": pdf["label"], "index": [i[f].tobytes() for (i, _), f in zip(parts, flags)],
                                "value": [v[f].tobytes() for (_, v), f in zip(parts, flags)]})

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, value, y = [], [], []
        for pdf in batches:
            index += [np.frombuffer(b, "<i4") for b in pdf["index"]]
            value += [np.frombuffer(b, "<f4") for b in pdf["value"]]
            y += pdf["label"].tolist()
        if y:
            emb, soft, bias = fit(np.concatenate(index), np.concatenate(value), np.array([len(i) for i in index]), np.array(y, dtype=np.float64))
            at = np.flatnonzero(emb.any(axis=1))
            yield pd.DataFrame({"at": [at.astype("<i4").tobytes()], "emb": [emb[at].astype("<f4").tobytes()], "soft": [soft.astype("<f8").tobytes()], "bias": [bias.astype("<f8").tobytes()]})

    with Stages(spark) as stages:
        schema = "label int, index binary, value binary"
        rows = stages.write(texts.mapInPandas(frugal(features), schema), "toxic-sample")
        # screen the buckets first, so that the task that fits holds only what teaches: 8 rows of a fixed size
        n0 = n1 = 0
        seen = np.zeros((2, BUCKETS))
        for r in rows.coalesce(8).mapInPandas(frugal(count), "n0 double, n1 double, seen binary").toLocalIterator():
            n0, n1 = n0 + r.n0, n1 + r.n1
            seen += np.frombuffer(zlib.decompress(r.seen), np.int32).reshape(2, BUCKETS)
        if not n0 or not n1:
            return None
        keep = telling(seen[1], seen[0], n1, n0)
        rows = stages.write(rows.mapInPandas(frugal(sift), schema), "toxic-telling")
        m = rows.coalesce(1).mapInPandas(frugal(solve), "at binary, emb binary, soft binary, bias binary").collect()[0]    # the model, of a fixed size
    emb = np.zeros((BUCKETS, DIM))
    emb[np.frombuffer(m.at, "<i4")] = np.frombuffer(m.emb, "<f4").reshape(-1, DIM)
    return emb, np.frombuffer(m.soft, "<f8").reshape(2, DIM), np.frombuffer(m.bias, "<f8")


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, label) of at most ``sample`` rows of each class that are not held out."""
    ids = labels.select("doc_id", F.col("toxic").cast("int").alias("label")).filter("doc_id is not null and label in (0, 1)")
    ids = ids.filter(doc_hash_mod(F.col("doc_id"), 3) != 1)
    some = [ids.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for c in (0, 1)]
    return docs.select("doc_id", "text").join(F.broadcast(some[0].unionAll(some[1])), "doc_id").select("text", "label")


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, np.ndarray] | None) -> Column:
    """The score of ``text`` as a column of ``docs``."""
    if model is None:
        return F.lit(0.0)
    emb, soft, biases = model
    bias = biases[1] - biases[0]
    shipped = docs.sparkSession.sparkContext.broadcast((emb @ (soft[1] - soft[0])).astype(np.float32))        # BUCKETS numbers

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        adds = shipped.value
        for texts in batches:
            out = np.empty(len(texts))
            for first, last, starts, weight, grams in bags(texts.tolist()):
                total, n = np.zeros(last - first), np.zeros(last - first)
                for bucket, ok in grams:
                    w = weight * ok
                    total += np.add.reduceat(adds[bucket] * w, starts, dtype=np.float64)
                    n += np.add.reduceat(w, starts, dtype=np.float64)
                out[first:last] = 1.0 / (1.0 + np.exp(-np.clip(total / (n + NEUTRAL) + bias, -30, 30)))
            yield pd.Series(out)
        give_back()

    return scores("text")


def fitted_score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Column:
    """The score column of a model fitted on the labelled rows of ``docs``."""
    return score(docs, train(labelled_sample(docs, labels, sample)))


def reject_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below CUT."""
    return docs.withColumn("_score", fitted_score(docs, labels, sample)).filter(F.col("_score") < CUT).drop("_score")


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    held = F.coalesce(doc_hash_mod(F.col("doc_id"), 3) == 1, F.lit(False))
    out = docs.select("doc_id", held.alias("held_out"), fitted_score(docs, labels, sample).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
