"""Katz back-off language model: fitting and scoring whole documents.

Tokens are white-space separated words (A-Z lower-cased) and one end token per
document; the first word's context is a start mark. Counts come from the
training documents, those whose crc32(doc_id as text) mod ``FOLDS`` is not
``HELD``. With Good-Turing discounts d_r for counts r up to ``GT``:

  P(w)   = d_r c(w) / (N + 1),  P(unknown) = 1 - sum of P(w)
  P(w|h) = d_r c(hw) / (c(h) + 1)      if c(hw) > 0
         = alpha(h) P(w)               otherwise
  alpha(h) = (1 - sum of P(w|h) over seen w) / (1 - sum of P(w) over seen w)

so every distribution sums to 1 exactly; the one added to a total keeps mass for
the unseen where no count is discounted. A discount that the counts of counts
do not support falls back to (r - 1/2) / r.

Texts are read once and never shuffled. A chunk of documents (about
``CHUNK_TOKENS`` tokens) keeps its vocabulary, and its tokens as numbers in it.

1. Unigrams: chunks send their vocabularies to hash ranges of words, which
   return the corpus counts. Words get numbers in order of falling count, so a
   word's number alone tells its count.
2. Bigrams: each chunk sends its distinct bigrams, with the documents that hold
   them, to buckets by context. A context with more than ``HOT`` of a bucket's
   size is dealt over several buckets by the next word.
3. A bucket has all that its contexts need: corpus counts of the bigrams, their
   share of seen mass, and each document's tokens. It is stored as one row:
   logs of the documents' seen tokens, unseen tokens by context, and the sums
   that make up the contexts' back-off weights. Those of split contexts are
   added up (at most 1 / HOT contexts a bucket).
4. The discounts are known once all buckets are stored. The tables are read
   once more, and each document's parts are added.

Defined cases: a null or empty text is an end token alone; a null doc_id is in
the training part; repeated rows are documents of their own; without training
documents all words are unknown and score log10 1 = 0 a token. Extra columns are
ignored. Word numbers are 32 bits: up to 4 billion distinct words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm.common import Stages, doc_hash_mod, pieces, runs, shuffle_partitions, table

FOLDS, HELD = 7, 2
GT = 5
CHUNK_TOKENS = 1_500_000
BUCKET_ENTRIES = 3_000_000
HOT = 0.25
START, UNKNOWN = np.uint32(0xFFFFFFFF), np.uint32(0xFFFFFFFE)


def pack(a: np.ndarray) -> bytes:
    """Byte planes of an array, compressed."""
    import zstandard
    a = np.ascontiguousarray(a)
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes())


def unpack(b: bytes, kind: str) -> np.ndarray:
    import zstandard
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b, max_output_size=1 << 31), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def discounts(n: np.ndarray) -> np.ndarray:
    """Good-Turing discounts d_0..d_GT (d_0 unused) from counts of counts n_0..n_(GT+1)."""
    d = np.array([1.0] + [(r - 0.5) / r for r in range(1, GT + 1)])
    if (n[1:GT + 2] > 0).all():
        cut = (GT + 1) * n[GT + 1] / n[1]
        for r in range(1, GT + 1):
            v = ((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut) if cut < 1 else -1.0
            if 0 < v < 1:
                d[r] = v
    return d


class Unigrams:
    """Counts by word number (falling with it) and the unigram distribution."""

    def __init__(self, counts: np.ndarray, words: np.ndarray, train_docs: int):
        """counts: the distinct counts, falling; words: how many words have each."""
        self.counts, self.first = counts.astype(np.int64), np.concatenate(([0], np.cumsum(words))).astype(np.int64)
        self.tokens, self.size, self.train_docs = int((counts * words).sum()), int(words.sum()), train_docs
        n = np.array([words[counts == r].sum() for r in range(GT + 2)])
        d = discounts(n)
        self.p = np.where(counts <= GT, d[np.minimum(counts, GT)], 1.0) * counts / (self.tokens + 1)
        self.p_unknown = 1.0 - float((self.p * words).sum())

    def _at(self, word: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, word, side="right") - 1

    def count(self, word: np.ndarray) -> np.ndarray:
        c = np.append(self.counts, 0)[np.minimum(self._at(word), len(self.counts))]
        return np.where(word == START, self.train_docs, np.where(word == UNKNOWN, 0, c))

    def prob(self, word: np.ndarray) -> np.ndarray:
        p = np.append(self.p, self.p_unknown)[np.minimum(self._at(word), len(self.counts))]
        return np.where(word == UNKNOWN, self.p_unknown, p)


def tokenise(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of all tokens, tokens of each text)."""
    from xxhash import xxh64_intdigest
    end = np.uint64(xxh64_intdigest(b" "))       # no word holds a space
    words = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
    n = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    out = np.full(int(n.sum()), end, dtype=np.uint64)
    body = np.ones(len(out), dtype=bool)
    body[np.cumsum(n) - 1] = False
    out[body] = np.fromiter((xxh64_intdigest(w) for ws in words for w in ws), dtype=np.uint64, count=len(out) - len(words))
    return out, n


CHUNKS = "chunk string, doc_ids array<string>, held binary, lens binary, n_words long, vocab binary, counts binary, tokens binary"


def chunks(docs: DataFrame) -> DataFrame:
    """One row per chunk: its documents, vocabulary, training counts and tokens."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq = TaskContext.get().partitionId(), 0
        ids, held, codes, lens, size = [], [], [], [], 0

        def close() -> pd.DataFrame:
            nonlocal ids, held, codes, lens, size, seq
            n = np.concatenate(lens)
            vocab, tokens = np.unique(np.concatenate(codes), return_inverse=True)
            train = np.repeat(~np.array(held, dtype=bool), n)
            counts = np.bincount(tokens[train], minlength=len(vocab)).astype(np.uint32)
            row = pd.DataFrame({"chunk": [f"{part}-{seq}"], "doc_ids": [ids], "held": [pack(np.array(held, dtype=np.uint8))], "lens": [pack(n.astype(np.uint32))],
                                "n_words": [len(vocab)], "vocab": [vocab.tobytes()], "counts": [pack(counts)], "tokens": [pack(tokens.astype(np.uint32))]})
            ids, held, codes, lens, size, seq = [], [], [], [], 0, seq + 1
            return row

        for pdf in batches:
            texts, keys, out = pdf["text"].tolist(), pdf["doc_id"].tolist(), pdf["held"].tolist()
            for a, b in pieces(texts, 4_000_000):
                c, n = tokenise(texts[a:b])
                ids += keys[a:b]
                held += out[a:b]
                codes.append(c)
                lens.append(n)
                size += len(c)
                if size >= CHUNK_TOKENS:
                    yield close()
        if ids:
            yield close()

    held = F.coalesce(doc_hash_mod(F.col("doc_id"), FOLDS) == HELD, F.lit(False)).alias("held")
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", held).mapInPandas(run, CHUNKS)


def count_words(stored: DataFrame, parts: int) -> DataFrame:
    """Corpus counts of every chunk's vocabulary, aligned with it, by hash range
    of the words; and for each range (chunk null) its counts of counts."""
    top = (2 ** 64 - 1) // parts + 1

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for chunk, vocab, counts in zip(pdf["chunk"], pdf["vocab"], pdf["counts"]):
                v, c = np.frombuffer(vocab, np.uint64), unpack(counts, "<u4")
                cut = np.searchsorted(v, np.array([p * top for p in range(1, parts)], dtype=np.uint64)).tolist()
                for p, (a, b) in enumerate(zip([0, *cut], [*cut, len(v)])):
                    if b > a:
                        yield pd.DataFrame({"part": [p], "chunk": [chunk], "vocab": [v[a:b].tobytes()], "counts": [pack(c[a:b])]})

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (part,), rows in runs(batches, ["part"]):
            v = [np.frombuffer(b, np.uint64) for b in rows["vocab"]]
            words, at = np.unique(np.concatenate(v), return_inverse=True)
            total = np.bincount(at, weights=np.concatenate([unpack(b, "<u4") for b in rows["counts"]]), minlength=len(words)).astype(np.int64)
            order = np.argsort(total, kind="stable")
            kinds, first, n = np.unique(total[order], return_index=True, return_counts=True)
            rank = np.empty(len(words), dtype=np.int64)
            rank[order] = np.arange(len(words)) - np.repeat(first, n)          # among the range's words of the same count
            stop = np.cumsum([len(x) for x in v])
            for chunk, a, b in zip(rows["chunk"], stop - [len(x) for x in v], stop):
                yield pd.DataFrame({"part": [part], "chunk": [chunk], "counts": [pack(total[at[a:b]])], "ranks": [pack(rank[at[a:b]].astype(np.uint32))]})
            yield pd.DataFrame({"part": [part], "chunk": [None], "counts": [pack(kinds)], "ranks": [pack(n.astype(np.uint32))]})

    sent = stored.select("chunk", "vocab", "counts").mapInPandas(send, "part int, chunk string, vocab binary, counts binary")
    return sent.repartition(parts, "part").sortWithinPartitions("part", "chunk").mapInPandas(merge, "part int, chunk string, counts binary, ranks binary")


SENT = "bucket int, chunk string, doc_ids array<string>, held binary, base binary, keys binary, n_occ binary, docs binary, tf binary"


def send_bigrams(joined: DataFrame, uni_shared, offsets_shared, buckets: int, hot: float) -> DataFrame:
    """Per chunk and bucket the distinct bigrams (context << 32 | word, sorted) and
    the documents that hold them; and per chunk (bucket < 0) its documents'
    unigram figures."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        uni, offsets = uni_shared.value, offsets_shared.value
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                word = []
                for r in sorted(row.found, key=lambda x: x["part"]):
                    c, rank = unpack(r["counts"], "<i8"), unpack(r["ranks"], "<u4")
                    kinds, first = offsets[r["part"]]
                    word.append(np.where(c > 0, first[np.searchsorted(kinds, c)] + rank, int(UNKNOWN)).astype(np.uint32))
                word = np.concatenate(word)[unpack(row.tokens, "<u4")]
                lens, held = unpack(row.lens, "<u4").astype(np.int64), unpack(row.held, "<u1")
                first = np.cumsum(lens) - lens
                doc = np.repeat(np.arange(len(lens), dtype=np.uint32), lens)
                count = uni.count(word)
                known = count > 0
                add = lambda x: np.add.reduceat(x, first) if len(x) else x
                base = add(np.log10((count + 1) / (uni.tokens + uni.size + 1)))
                context = np.empty_like(word)
                context[1:] = word[:-1]
                context[first] = START
                c_context = uni.count(context)
                alone = c_context == 0           # nothing follows an unknown context: the unigram probability stands
                plain = add(np.where(alone, np.log10(uni.prob(word)), 0.0))
                own = -1 - zlib.crc32(row.chunk.encode()) % buckets
                yield pd.DataFrame({"bucket": [own], "chunk": [row.chunk], "doc_ids": [list(row.doc_ids)], "held": [row.held],
                                    "base": [pack(np.concatenate([lens.astype(np.float64), add(known.astype(np.float64)), base, plain]))],
                                    "keys": [None], "n_occ": [None], "docs": [None], "tf": [None]})
                use = ~alone
                key, d = (context[use].astype(np.uint64) << np.uint64(32)) | word[use], doc[use]
                del context, c_context, alone, count, known, doc, word, use
                order = np.argsort(key, kind="stable")                          # equal keys stay in order of document
                key, d = key[order], d[order]
                if not len(key):
                    continue
                new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (d[1:] != d[:-1])])
                tf, key, d = np.diff(np.r_[new, len(key)]), key[new], d[new]
                split = np.maximum(1, np.ceil(uni.count((key >> np.uint64(32)).astype(np.uint32)) / hot)).astype(np.uint64)
                mix = (key >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15) + ((key * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)) % split * np.uint64(0xC2B2AE3D27D4EB4F)
                bucket = ((mix ^ (mix >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)) % np.uint64(buckets)
                order = np.argsort(bucket.astype(np.uint16) if buckets <= 65_536 else bucket, kind="stable")
                bucket, key, d, tf = bucket[order], key[order], d[order], tf[order]
                cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
                for a, b in zip(cut[:-1], cut[1:]):
                    k = key[a:b]
                    at = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
                    yield pd.DataFrame({"bucket": [int(bucket[a])], "chunk": [row.chunk], "doc_ids": [None], "held": [row.held], "base": [None], "keys": [pack(k[at])],
                                        "n_occ": [pack(np.diff(np.r_[at, b - a]).astype(np.uint32))], "docs": [pack(d[a:b])], "tf": [pack(tf[a:b].astype(np.uint32))]})

    return joined.mapInPandas(run, SENT)


BUCKETS = ("bucket int, chunks array<string>, doc_ids array<array<string>>, held array<binary>, base array<binary>, docs array<binary>, sums array<binary>, "
           "low array<binary>, un_context array<binary>, un_doc array<binary>, un_tf array<binary>, contexts binary, stats binary, split_contexts binary, split_stats binary, kinds binary")


def fill_buckets(sent: DataFrame, uni_shared, partitions: int, hot: float) -> DataFrame:
    """One row per bucket, see the module's text."""

    def solve(bucket: int, rows: pd.DataFrame, uni: Unigrams) -> dict:
        keys = [unpack(b, "<u8") for b in rows["keys"]]
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        stop = np.cumsum([len(k) for k in keys])
        spans = list(zip(stop - [len(k) for k in keys], stop))
        occ = [(unpack(o, "<u4").astype(np.int64), unpack(d, "<u4"), unpack(t, "<u4").astype(np.float64)) for o, d, t in zip(rows["n_occ"], rows["docs"], rows["tf"])]
        count = np.zeros(len(key))
        for (a, b), (n, d, t), held in zip(spans, occ, rows["held"]):
            train = unpack(held, "<u1")[d] == 0
            count[at[a:b]] += np.add.reduceat(t * train, np.cumsum(n) - n)       # a chunk has each key once
        context, word = (key >> np.uint64(32)).astype(np.uint32), key.astype(np.uint32)
        seen = count > 0
        p = uni.prob(word)
        value = np.log10(np.where(seen, count / (uni.count(context) + 1), p))
        start = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
        total = lambda x: np.add.reduceat(x, start)
        stats = np.stack([total(np.where(count == r, r, 0.0)) for r in range(1, GT + 1)] + [total(np.where(count > GT, count, 0.0)), total(np.where(seen, p, 0.0))])
        group = np.cumsum(np.r_[0, context[1:] != context[:-1]])
        split = np.ceil(uni.count(context[start]) / hot) > 1
        out = {"bucket": bucket, "chunks": list(rows["chunk"]), "doc_ids": None, "held": None, "base": None, "docs": [], "sums": [], "low": [], "un_context": [], "un_doc": [], "un_tf": []}
        asked = np.zeros(len(start), dtype=bool)
        for (a, b), (n, d, t) in zip(spans, occ):
            e = np.repeat(at[a:b], n)
            docs, where = np.unique(d, return_inverse=True)
            out["docs"].append(pack(docs))
            out["sums"].append(pack(np.bincount(where, weights=value[e] * t, minlength=len(docs))))
            out["low"].append(pack(np.stack([np.bincount(where, weights=t * (count[e] == r), minlength=len(docs)) for r in range(1, GT + 1)]).astype(np.uint32).ravel()))
            un = ~seen[e]
            out["un_context"].append(group[e[un]])
            out["un_doc"].append(pack(d[un]))
            out["un_tf"].append(pack(t[un].astype(np.uint32)))
            asked[group[e[un]]] = True
        place = np.cumsum(asked) - 1
        out["un_context"] = [pack(place[g].astype(np.uint32)) for g in out["un_context"]]
        out["contexts"], out["stats"] = pack(context[start][asked]), pack(stats[:, asked].ravel())
        out["split_contexts"], out["split_stats"] = pack(context[start][split]), pack(stats[:, split].ravel())
        out["kinds"] = pack(np.bincount(np.minimum(count, GT + 2).astype(np.int64), minlength=GT + 3)[:GT + 2])
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        uni = uni_shared.value
        names = [c.split()[0] for c in BUCKETS.split(", ")]
        for (bucket,), rows in runs(batches, ["bucket"]):
            if bucket >= 0:
                yield pd.DataFrame({k: [v] for k, v in solve(int(bucket), rows, uni).items()})[names]
            else:
                for r in rows.itertuples(index=False):
                    one = dict.fromkeys(names)
                    one |= {"bucket": int(bucket), "chunks": [r.chunk], "doc_ids": [list(r.doc_ids)], "held": [r.held], "base": [r.base]}
                    yield pd.DataFrame({k: [v] for k, v in one.items()})[names]

    return sent.repartition(partitions, "bucket").sortWithinPartitions("bucket", "chunk").mapInPandas(run, BUCKETS)


def back_off(d: np.ndarray, contexts: np.ndarray, stats: np.ndarray, uni: Unigrams) -> np.ndarray:
    """alpha of contexts from their sums (GT + 2 rows)."""
    mass = (d[1:, None] * stats[:GT]).sum(0) + stats[GT]
    return (1.0 - mass / (uni.count(contexts) + 1)) / (1.0 - stats[GT + 1])


def add_up(filled: DataFrame, uni_shared, d: np.ndarray, split: dict[int, np.ndarray], kind: str, partitions: int) -> DataFrame:
    """The documents' scores."""

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        uni = uni_shared.value
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                if row.bucket < 0:
                    yield pd.DataFrame({"chunk": list(row.chunks), "doc_ids": [list(row.doc_ids[0])], "held": list(row.held), "docs": list(row.base), "sums": [None]})
                    continue
                contexts = unpack(row.contexts, "<u4")
                stats = unpack(row.stats, "<f8").reshape(GT + 2, -1).copy()
                for i, c in enumerate(contexts.tolist()) if split else ():
                    if c in split:
                        stats[:, i] = split[c]
                log_alpha = np.log10(back_off(d, contexts, stats, uni)) if len(contexts) else np.zeros(0)
                for chunk, docs, sums, low, uc, ud, ut in zip(row.chunks, row.docs, row.sums, row.low, row.un_context, row.un_doc, row.un_tf):
                    docs, ud = unpack(docs, "<u4"), unpack(ud, "<u4")
                    s = unpack(sums, "<f8") + np.log10(d[1:]) @ unpack(low, "<u4").reshape(GT, -1)
                    s += np.bincount(np.searchsorted(docs, ud), weights=log_alpha[unpack(uc, "<u4")] * unpack(ut, "<u4"), minlength=len(docs))
                    yield pd.DataFrame({"chunk": [chunk], "doc_ids": [None], "held": [None], "docs": [pack(docs)], "sums": [pack(s)]})

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = uni_shared.value.tokens
        for _, rows in runs(batches, ["chunk"]):
            score, base = None, None
            rows = rows.assign(first=rows["sums"].notna()).sort_values("first", kind="stable")
            for r in rows.itertuples(index=False):
                if r.sums is None:
                    base = unpack(r.docs, "<f8").reshape(4, -1)
                    score, ids, held = base[3].copy(), list(r.doc_ids), unpack(r.held, "<u1") > 0
                else:
                    score[unpack(r.docs, "<u4")] += unpack(r.sums, "<f8")
            yield pd.DataFrame({"doc_id": ids, "held_out": held, "n_tokens": base[0].astype(np.int64), "n_known": base[1].astype(np.int64),
                                "train_tokens": np.full(len(ids), tokens), "base_score": base[2], "score": score})

    sent = filled.mapInPandas(send, "chunk string, doc_ids array<string>, held binary, docs binary, sums binary")
    out = sent.repartition(partitions, "chunk").sortWithinPartitions("chunk").mapInPandas(
        merge, "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def katz_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    sc, partitions = spark.sparkContext, shuffle_partitions(spark)
    kind = dict(docs.dtypes)["doc_id"]
    with Stages(spark) as stages:
        stored = stages.write(chunks(docs), "chunks")
        sizes = stored.agg(F.sum("n_words"), F.count(F.lit(1))).first()
        parts = max(1, -(-int(sizes[0] or 0) // BUCKET_ENTRIES))
        counted = stages.write(count_words(stored, parts), "unigrams")
        # per hash range its counts of counts: as many numbers as there are different counts
        kinds = {r.part: (unpack(r.counts, "<i8"), unpack(r.ranks, "<u4").astype(np.int64)) for r in counted.filter("chunk is null").select("part", "counts", "ranks").collect()}
        values = np.unique(np.concatenate([k for k, _ in kinds.values()] or [np.zeros(0, np.int64)]))[::-1]
        values = values[values > 0]
        per = {}
        for p, (k, n) in kinds.items():          # k rises, values fall
            per[p] = np.zeros(len(values), dtype=np.int64)
            per[p][len(values) - 1 - np.searchsorted(values[::-1], k[k > 0])] = n[k > 0]
        every = sum(per.values()) if per else np.zeros(0, np.int64)
        first = np.concatenate(([0], np.cumsum(every)))[:-1]
        offsets = {}
        for p in sorted(per):                    # first number of the range's words with each count, counts rising
            offsets[p] = (np.concatenate(([0], values[::-1])), np.concatenate(([0], first[::-1])))
            first = first + per[p]
        train_docs = docs.select((F.coalesce(doc_hash_mod(F.col("doc_id"), FOLDS), F.lit(-1)) != HELD).cast("long").alias("t")).agg(F.sum("t")).first()[0] or 0
        uni = Unigrams(values, every, train_docs)
        uni_shared, offsets_shared = sc.broadcast(uni), sc.broadcast(offsets)

        replies = counted.filter("chunk is not null").groupBy("chunk").agg(F.collect_list(F.struct("part", "counts", "ranks")).alias("found"))   # a chunk's vocabulary
        joined = stored.select("chunk", "doc_ids", "held", "lens", "tokens").join(replies, "chunk")
        buckets = max(partitions, -(-uni.tokens // BUCKET_ENTRIES))
        hot = max(1.0, HOT * uni.tokens / buckets)
        filled = stages.write(fill_buckets(send_bigrams(joined, uni_shared, offsets_shared, buckets, hot), uni_shared, buckets, hot), "buckets", keep=True)

        n, split = np.zeros(GT + 2), {}
        # a few numbers a bucket, and 1 / HOT contexts at most
        for r in filled.filter("bucket >= 0").select("kinds", "split_contexts", "split_stats").toLocalIterator():
            n += unpack(r.kinds, "<i8")
            stats = unpack(r.split_stats, "<f8").reshape(GT + 2, -1)
            for i, c in enumerate(unpack(r.split_contexts, "<u4").tolist()):
                split[c] = split.get(c, 0) + stats[:, i]
    return add_up(filled, uni_shared, discounts(n), split, kind, partitions)


def op9_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(table(spark, sf_dir, "documents"))
