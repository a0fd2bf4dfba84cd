"""Token-id files of directly addressable codes.

Every document is encoded with a tokenizer file, an end id is appended, and the
ids go, in ascending document order, into binary segment files. In a segment
each id is split into chunks of ``CHUNK_BITS`` bits, least significant first.
Level k holds the k-th chunk of every id that has one, a continuation bitmap
(bit i set: entry i goes on in level k + 1) and a rank directory (set bits
before each block of ``RANK_BLOCK`` entries). Entry i of level 1 is token i;
its next chunk sits at position rank(i) of the next level, so any token is
found by a few small reads, without decoding a block.

Segment file, little-endian:
  magic ``DAC1``, u32 chunk bits, u32 levels, u64 documents, u64 tokens,
  levels x u64 entries; then doc ids (i64), null flags (u8), token offsets
  (u64, documents + 1); then for each level: chunks (u8), bitmap (u8, LSB
  first), rank directory (u64, one per block, and the total).

Each write task streams its documents and closes a segment at
``segment_tokens`` ids, so memory is bounded by that and by the longest
document. A segment's name holds a fresh id of the attempt and only segments in
the manifest exist for readers: a task that runs twice, or is lost half-way,
leaves at most a file that nobody reads.

Defined cases: a null or empty text holds the end id only; a null doc_id comes
first; rows that repeat a doc_id are separate documents, ordered by the hash of
their text and then the text; extra columns are ignored; an empty table gives
an empty manifest.
"""

from __future__ import annotations

import gc
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlink.llm.common import frugal, keep_for_task, scratch_path, stage, worker_cache

CHUNK_BITS = 8
RANK_BLOCK = 512
MAGIC = b"DAC1"
#: Lower-case letters that the tokenizer's normaliser leaves as they are.
PLAIN = re.compile("[a-zß-öø-ÿ]+")
#: Characters encoded at a time.
ENCODE_CHARS = 8_000_000
MANIFEST = "part int, seq int, path string, n_docs long, n_tokens long"


# ---------------------------------------------------------------- tokenizing

class WordEncoder:
    """Encodes texts with a tokenizer, each distinct white-space separated piece
    once. The tokenizer file drops white space and never joins across it, so
    the ids of a text are those of its pieces in order. Pieces of letters only
    go through the same BPE model many at a time."""

    #: Characters of the pieces that are kept.
    MAX_CHARS = 4_000_000

    def __init__(self, json: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.whole = Tokenizer.from_str(json)
        self.letters = Tokenizer.from_str(json)
        self.letters.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.whole.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        for token, i in vocab.items():
            self.ends[i] = token.endswith("</w>")
        self.known: dict[str, bytes] = {}
        self.chars = 0

    def _whole(self, pieces: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.whole.encode_batch_fast(pieces, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(words), 5000):
            some = words[at:at + 5000]
            ids = np.array(self.letters.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(cuts) != len(some):           # not one word end a word: take the plain way
                out += self._whole(some)
                continue
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist())]
        return out

    def learn(self, pieces: list[str]) -> None:
        if self.chars > self.MAX_CHARS:
            self.known, self.chars = {}, 0
        known = self.known
        new = [p for p in pieces if p not in known]
        self.chars += sum(map(len, new))
        body = {p: p.rstrip(".,") for p in new}
        plain = list({b for b in body.values() if b not in known and PLAIN.fullmatch(b)})
        known.update(zip(plain, self._letters(plain)))
        tails = list({p[len(body[p]):] for p in new} - {""} - known.keys())
        known.update(zip(tails, self._whole(tails)))
        rest = []
        for p, b in body.items():
            if p in known:
                continue
            if b in known and b and p != b:      # letters, then full stops and commas
                known[p] = known[b] + known[p[len(b):]]
            else:
                rest.append(p)
        known.update(zip(rest, self._whole(rest)))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each). Texts that may hold a special
        token, which is found before letters are made lower case, go through the
        tokenizer as they stand."""
        whole = [i for i, t in enumerate(texts) if t and "<|" in t]
        if not whole:
            return self._encode(texts)
        rest = list(texts)
        for i in whole:
            rest[i] = None
        ids, n = self._encode(rest)
        parts = np.split(ids, np.cumsum(n)[:-1])
        for i in whole:
            parts[i] = np.frombuffer(self._whole([texts[i]])[0], dtype="<u4")
            n[i] = len(parts[i])
        return np.concatenate(parts), n

    def _encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        import pyarrow as pa
        import pyarrow.compute as pc
        if not texts:
            return np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64)
        gc.disable()                             # no cycles here, and a great many entries to search for them
        try:
            return self._encode_flat(texts, pa, pc)
        finally:
            gc.enable()

    def _encode_flat(self, texts: list[str | None], pa, pc) -> tuple[np.ndarray, np.ndarray]:
        flat = pc.replace_substring(pc.ascii_lower(pa.array([t or "" for t in texts], pa.large_string())), "\n", " ")
        parts = pc.split_pattern(flat, " ")
        coded = parts.flatten().dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        self.learn(pieces)
        raw = [self.known.get(p) for p in pieces]
        lens = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) // 4
        ids = np.frombuffer(b"".join(raw), dtype="<u4")
        at = np.concatenate(([0], np.cumsum(lens)))[:-1]
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        n = lens[index]
        stop = np.cumsum(n)
        out = ids[np.repeat(at[index] - (stop - n), n) + np.arange(int(n.sum()))]
        ends = np.concatenate(([0], stop))[parts.offsets.to_numpy()]
        return out, np.diff(ends)


def encoder(json: str) -> WordEncoder:
    key = ("tokenizer", zlib.crc32(json.encode()))
    cache = worker_cache()
    keep_for_task(key)
    if key not in cache:
        cache[key] = WordEncoder(json)
    return cache[key]


# --------------------------------------------------------------- file format

def pack(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Levels of (chunks, continuation bitmap, rank directory)."""
    levels = []
    rest = ids.astype(np.uint32, copy=False)
    while True:
        more = rest >= (1 << CHUNK_BITS)
        blocks = np.add.reduceat(more, np.arange(0, len(more), RANK_BLOCK), dtype=np.uint64) if len(more) else np.zeros(0, np.uint64)
        ranks = np.concatenate((np.zeros(1, np.uint64), np.cumsum(blocks, dtype=np.uint64)))
        levels.append(((rest & ((1 << CHUNK_BITS) - 1)).astype(np.uint8), np.packbits(more, bitorder="little"), ranks))
        if not more.any():
            return levels
        rest = rest[more] >> CHUNK_BITS


def segment_bytes(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> list[bytes]:
    levels = pack(ids)
    head = MAGIC + struct.pack("<IIQQ", CHUNK_BITS, len(levels), len(doc_ids), len(ids))
    head += b"".join(struct.pack("<Q", len(c)) for c, _, _ in levels)
    nulls = np.array([d is None for d in doc_ids], dtype=np.uint8)
    offsets = np.concatenate(([0], np.cumsum(counts))).astype("<u8")
    out = [head, np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(), nulls.tobytes(), offsets.tobytes()]
    for chunks, bitmap, ranks in levels:
        out += [chunks.tobytes(), bitmap.tobytes(), ranks.astype("<u8").tobytes()]
    return out


def _file_system(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


class Segment:
    """Random access to one segment file."""

    def __init__(self, path: str):
        system, inner = _file_system(path)
        self.file = system.open_input_file(inner)
        magic, bits, n_levels, self.n_docs, self.n_tokens = struct.unpack("<4sIIQQ", self.file.read_at(28, 0))
        if magic != MAGIC or bits != CHUNK_BITS:
            raise ValueError(f"not a token segment: {path}")
        entries = struct.unpack(f"<{n_levels}Q", self.file.read_at(8 * n_levels, 28))
        self.docs_at = 28 + 8 * n_levels
        at = self.docs_at + self.n_docs * 9 + 8 * (self.n_docs + 1)
        self.levels = []
        for n in entries:
            bitmap = at + n
            ranks = bitmap + -(-n // 8)
            self.levels.append((n, at, bitmap, ranks))
            at = ranks + 8 * (-(-n // RANK_BLOCK) + 1)

    def _rank(self, level: int, i: int) -> int:
        """Set bits of the level's bitmap before entry i."""
        _, _, bitmap, ranks = self.levels[level]
        block = i // RANK_BLOCK
        base = struct.unpack("<Q", self.file.read_at(8, ranks + 8 * block))[0]
        first = block * RANK_BLOCK
        bits = np.unpackbits(np.frombuffer(self.file.read_at(-(-(i - first) // 8), bitmap + first // 8), np.uint8), bitorder="little")
        return base + int(bits[:i - first].sum())

    def token(self, i: int) -> int:
        """Token i of the segment: one byte of each level it reaches."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value, shift = 0, 0
        for level, (_, chunks, bitmap, _) in enumerate(self.levels):
            value |= self.file.read_at(1, chunks + i)[0] << shift
            if not self.file.read_at(1, bitmap + i // 8)[0] >> (i % 8) & 1:
                return value
            i, shift = self._rank(level, i), shift + CHUNK_BITS
        raise ValueError("a continuation bit is set on the last level")

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """Tokens start to stop, by reading that range of every level."""
        out = np.zeros(max(0, stop - start), dtype="<u4")
        where, shift = np.arange(len(out)), 0
        for level, (n, chunks, bitmap, _) in enumerate(self.levels):
            if not len(where):
                break
            out[where] |= np.frombuffer(self.file.read_at(len(where), chunks + start), np.uint8).astype("<u4") << np.uint32(shift)
            first = start // 8 * 8
            bits = np.unpackbits(np.frombuffer(self.file.read_at(-(-(start + len(where) - first) // 8), bitmap + first // 8), np.uint8), bitorder="little")
            more = bits[start - first:start - first + len(where)].astype(bool)
            if level + 1 < len(self.levels):
                start = self._rank(level, start)
            where, shift = where[more], shift + CHUNK_BITS
        return out

    def documents(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(doc ids, null flags, token offsets)."""
        n = self.n_docs
        raw = self.file.read_at(n * 9 + 8 * (n + 1), self.docs_at)
        return (np.frombuffer(raw, "<i8", n), np.frombuffer(raw, np.uint8, n, 8 * n).astype(bool),
                np.frombuffer(raw, "<u8", n + 1, 9 * n).astype(np.int64))


# ---------------------------------------------------------------- Spark jobs

def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None,
                      segment_tokens: int = 4_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and write all documents; the manifest (one row a segment) as a
    stored table. The folder must be one that all executors share."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    with open(tokenizer_path, encoding="utf-8") as f:
        json = f.read()

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq = TaskContext.get().partitionId(), 0
        enc = encoder(json)
        system, inner = _file_system(folder)
        ids: list[int | None] = []
        counts: list[int] = []
        codes: list[np.ndarray] = []
        held = 0

        def close() -> pd.DataFrame:
            nonlocal ids, counts, codes, held, seq
            name = f"seg-{part:06d}-{seq:06d}-{uuid.uuid4().hex}.dac"
            system.create_dir(inner, recursive=True)
            with system.open_output_stream(f"{inner}/{name}") as out:
                for block in segment_bytes(ids, np.array(counts), np.concatenate(codes)):
                    out.write(block)
            row = pd.DataFrame({"part": [part], "seq": [seq], "path": [f"{folder}/{name}"], "n_docs": [len(ids)], "n_tokens": [held]})
            ids, counts, codes, held, seq = [], [], [], 0, seq + 1
            return row

        for pdf in batches:
            texts, keys = pdf["text"].tolist(), pdf["doc_id"].tolist()
            at = 0
            while at < len(texts):
                stop, chars = at, 0
                while stop < len(texts) and (stop == at or chars < ENCODE_CHARS):
                    chars += len(texts[stop] or "")
                    stop += 1
                got, n = enc.encode(texts[at:stop])
                for key, doc in zip(keys[at:stop], np.split(got, np.cumsum(n)[:-1])):
                    if held and held + len(doc) + 1 > segment_tokens:
                        yield close()
                    ids.append(None if key is None or key != key else int(key))
                    counts.append(len(doc) + 1)
                    codes += [doc, np.array([end_id], dtype="<u4")]
                    held += len(doc) + 1
                at = stop
        if ids:
            yield close()

    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"),
                       F.col(id_col).cast("long").alias("_i"), F.xxhash64(F.col(text_col)).alias("_h"))
    ordered = rows.repartitionByRange("_i", "_h").sortWithinPartitions("_i", "_h", "text").select("doc_id", "text")
    return stage(ordered.mapInPandas(frugal(write), MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame, block_tokens: int = 2_000_000) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    # one row per segment: a few integers each, so one task can number them
    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, base in zip(pdf["path"], pdf["base"]):
                seg = Segment(path)
                doc_ids, nulls, offsets = seg.documents()
                first = 0
                while first < seg.n_docs:
                    last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + block_tokens, side="right")) - 1)
                    raw = memoryview(seg.tokens(int(offsets[first]), int(offsets[last])).tobytes())
                    cuts = ((offsets[first:last + 1] - offsets[first]) * 4).tolist()
                    yield pd.DataFrame({
                        "doc_id": pd.Series(doc_ids[first:last]).astype("Int64").mask(nulls[first:last]),
                        "start": base + offsets[first:last],
                        "n_tokens": np.diff(offsets[first:last + 1]),
                        "ids_crc32": np.array([zlib.crc32(raw[a:b]) for a, b in zip(cuts, cuts[1:])], dtype=np.int64),
                    })
                    first = last

    n = max(1, manifest.rdd.getNumPartitions())
    return bases.repartition(n).mapInPandas(frugal(read), "doc_id long, start long, n_tokens long, ids_crc32 long")


def word_tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def token_digest(docs: DataFrame, tokenizer_path: str | None = None, end_id: int = 2, **kw) -> DataFrame:
    """Write the token files of ``docs`` and read every document back."""
    return read_token_files(write_token_files(docs, tokenizer_path or word_tokenizer_path(), end_id, **kw))


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlink.llm.common import table
    return token_digest(table(spark, sf_dir, "documents"))
