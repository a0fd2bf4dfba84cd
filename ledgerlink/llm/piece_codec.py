"""SentencePiece encoding and decoding by a prefix table.

A model of merge type starts from the characters of a text and always merges
the adjacent pair with the best score, the leftmost of equals, until no pair
forms a piece. If a final boundary lies at p, no merge ever crossed p, so the
left part was merged as if it stood alone; and a row of pieces is the result
exactly if each piece is the result for its own characters and each two
neighbours are the result for theirs. Hence each prefix of a text has one last
token, the one piece that ends there and is compatible with the last token of
the prefix before it.

``PieceCodec`` finds the pieces that end at each character with an Aho-Corasick
automaton, keeps that last token for each prefix (a character that no piece
covers stands for itself) and reads the ids off backwards. Whether two pieces
are compatible is found by replaying the merges of both side by side: they are
not, if the pair over the boundary is ever due before the next merge of either.

Where no piece of the model holds two neighbouring characters of certain kinds,
two tokens always meet between them. So if no piece goes from another character
to the word mark, from a letter to another character or back, or holds a line end,
texts are cut there, and a distinct part is encoded once while a worker's
cache holds it. Other models are handled as one part a text.

Decoding maps ids to the bytes of their pieces, word marks to blanks, drops the
one mark that encoding put in front, and replaces each byte that is no valid
UTF-8 by U+FFFD.

Models must be of merge type with byte pieces, and their normaliser must do no more
than put one mark in front and turn blanks into marks; others raise ValueError.
Symbols defined by the user have no place in such a model.

Defined cases: a null text counts as empty and has the end id only; a null or
repeated doc_id is kept, a row each; extra columns are ignored; an empty table
gives an empty result. Long texts are handled whole, about ``MOST_CHARS``
characters at a time otherwise.
"""

from __future__ import annotations

import gc
import hashlib
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm.common import frugal, keep_for_task, pieces, table, worker_cache

MARK = "▁"
MOST_CHARS = 1_000_000
#: Bounds of a worker's caches: parts (of at most ``LONGEST`` characters) and pairs.
MOST_PARTS = 400_000
MOST_PAIRS = 400_000
LONGEST = 64


class PieceCodec:
    """Encoder and decoder of one model."""

    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        kind = ["byte" if sp.is_byte(i) else "unknown" if sp.is_unknown(i) else "control" if sp.is_control(i) or sp.is_unused(i) else "piece"
                for i in range(n)]
        if kind.count("byte") != 256 or sp.normalize(" a  ﬁ ") != f"{MARK}{MARK}a{MARK}{MARK}ﬁ{MARK}":
            raise ValueError("the model needs byte pieces and a normaliser that only marks blanks")
        self.end_id = sp.eos_id()
        names = [sp.id_to_piece(i) for i in range(n)]
        self.ids = {names[i]: i for i in range(n) if kind[i] == "piece"}
        #: The lower, the sooner a pair that forms the piece is merged.
        self.due = {names[i]: -sp.get_score(i) for i in range(n) if kind[i] == "piece"}
        byte_ids = {int(names[i][1:-1], 16): i for i in range(n) if kind[i] == "byte"}
        self.byte_ids = [byte_ids[b] for b in range(256)]
        self.found = ahocorasick.Automaton()
        #: By piece: whether a token may stand before it.
        self.pairs: dict[str, dict[str, bool]] = {}
        self.n_pairs = 0
        self.merges: dict[str, tuple | None] = {}
        for piece in self.ids:
            if self.replay(piece) is not None:
                self.found.add_word(piece, (piece, len(piece), self.pairs.setdefault(piece, {})))
        self.found.make_automaton()
        self.parts: dict[str, bytes] = {}
        self.cut = None
        odd = {c for p in self.ids for c in p if c.isalnum() and not c.isalpha() and not c.isdecimal()}
        letter, other = "[^\\W\\d_" + re.escape("".join(sorted(odd))) + "]", f"[^{MARK}\\n]"
        if not any(re.search(f"[^{MARK}]{MARK}|\n", p) for p in self.ids):
            mixed = re.compile(f"{letter}(?!{letter}){other}|(?!{letter}){other}{letter}")
            self.cut = re.compile(f"{MARK}*{other}+|{MARK}+|\n+" if any(map(mixed.search, self.ids)) else
                                  f"{MARK}*{letter}+|{MARK}*(?:(?!{letter}){other})+|{MARK}+|\n+")

        text = ["" if k == "control" else " \u2047 " if k == "unknown" else p.replace(MARK, " ") for p, k in zip(names, kind)]
        self.is_byte = np.array([k == "byte" for k in kind])
        self.starts_word = np.array([k == "piece" and p.startswith(MARK) for p, k in zip(names, kind)])
        self.is_control = np.array([k == "control" for k in kind])
        surface = [bytes([int(p[1:-1], 16)]) if k == "byte" else t.encode() for p, t, k in zip(names, text, kind)]
        self.surface = ragged_table(surface)
        self.decimal = ragged_table([b"%d " % i for i in range(n)])

    # ------------------------------------------------------------- encoding

    def replay(self, piece: str) -> tuple | None:
        """The merges inside a piece, in order: (when due, last symbols, first
        symbols), the symbols with the state before the first merge in front.
        None if merging does not lead to the piece."""
        if piece not in self.merges:
            symbols, when = list(piece), []
            last, first = [symbols[-1]], [symbols[0]]
            while len(symbols) > 1:
                due = [self.due.get(a + b, np.inf) for a, b in zip(symbols, symbols[1:])]
                at = min(range(len(due)), key=due.__getitem__)
                if due[at] == np.inf:
                    break
                symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
                when.append(due[at])
                last.append(symbols[-1])
                first.append(symbols[0])
            self.merges[piece] = (when, last, first) if len(symbols) == 1 else None
        return self.merges[piece]

    def compatible(self, a: str, b: str) -> bool:
        """Whether the text of two pieces is encoded as just these two."""
        before = self.pairs[b]
        if a not in before:
            if self.n_pairs >= MOST_PAIRS:
                self.n_pairs = 0
                for known in self.pairs.values():
                    known.clear()
            self.n_pairs += 1
            before[a] = self._apart(*self.replay(a)[:2], *self.replay(b)[::2])
        return before[a]

    def _apart(self, when_a: list, last: list, when_b: list, first: list) -> bool:
        i = j = 0
        while True:
            due_a = when_a[i] if i < len(when_a) else np.inf
            due_b = when_b[j] if j < len(when_b) else np.inf
            over = self.due.get(last[i] + first[j], np.inf)
            if over < due_a and over <= due_b and over < np.inf:       # of equals the leftmost is first
                return False
            if due_a == due_b == np.inf:
                return True
            if due_a <= due_b:
                i += 1
            else:
                j += 1

    def last_tokens(self, part: str) -> list[str]:
        """The last token of each prefix that is not empty."""
        last: list[str] = []
        add, n = last.append, 0                              # n: prefixes done
        for end, (piece, size, before) in self.found.iter(part):     # of one end the longest first
            if n > end:
                continue
            while n < end:                                   # no piece ends there
                add(part[n])
                n += 1
            if size <= end:
                fits = before.get(last[end - size])
                if not (self.compatible(last[end - size], piece) if fits is None else fits):
                    continue
            add(piece)
            n += 1
        return last + list(part[n:])

    def encode_part(self, part: str) -> bytes:
        """Ids (4 bytes each) of a part of marked text."""
        last, at, out, ids = self.last_tokens(part), len(part), array("I"), self.ids
        while at:
            token = last[at - 1]
            i = ids.get(token)
            if i is None:
                out.extend([self.byte_ids[b] for b in reversed(token.encode())])
            else:
                out.append(i)
            at -= len(token)
        out.reverse()
        return out.tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text, without the end id."""
        if not text:
            return np.zeros(0, dtype=np.uint32)
        marked = MARK + text.replace(" ", MARK)
        parts = self.cut.findall(marked) if self.cut else [marked]
        raw = list(map(self.parts.get, parts))
        if None in raw:
            raw = [self._learned(p) if r is None else r for p, r in zip(parts, raw)]
        return np.frombuffer(b"".join(raw), dtype=np.uint32)

    def _learned(self, part: str) -> bytes:
        ids = self.parts.get(part) or self.encode_part(part)
        if len(part) <= LONGEST:
            if len(self.parts) >= MOST_PARTS:
                self.parts.clear()
            self.parts[part] = ids
        return ids

    # ------------------------------------------------------------- decoding

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, as the library's ``decode`` gives it."""
        ids = np.asarray(ids, dtype=np.int64)
        ids = ids[~self.is_control[ids]]
        raw = gather(self.surface, ids)
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = self._decode_runs(ids)
        # the mark in front: of the first piece that is no byte, with no text before it
        return text[1:] if len(ids) and self.starts_word[ids[0]] else text

    def _decode_runs(self, ids: np.ndarray) -> str:
        out = []
        edges = np.flatnonzero(np.diff(self.is_byte[ids].astype(np.int8))) + 1
        for run in np.split(ids, edges):
            raw = gather(self.surface, run)
            while raw:
                try:
                    out.append(raw.decode())
                    break
                except UnicodeDecodeError as e:              # one U+FFFD for each byte that starts no character
                    out.append(raw[:e.start].decode() + "�")
                    raw = raw[e.start + 1:]
        return "".join(out)

    def ids_text(self, ids: np.ndarray) -> bytes:
        """Decimal ids joined by one space."""
        return gather(self.decimal, np.asarray(ids, dtype=np.int64))[:-1]


def ragged_table(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all values, where each starts, its length)."""
    lens = np.array([len(v) for v in values], dtype=np.int64)
    return np.frombuffer(b"".join(values), dtype=np.uint8), np.cumsum(lens) - lens, lens


def gather(ragged: tuple[np.ndarray, np.ndarray, np.ndarray], index: np.ndarray, at_once: int = 1 << 18) -> bytes:
    """The values at ``index``, joined."""
    flat, at, lens = ragged
    out = []
    for a in range(0, len(index), at_once):
        some = index[a:a + at_once]
        n = lens[some]
        stop = np.cumsum(n)
        out.append(flat[np.repeat(at[some] - (stop - n), n) + np.arange(int(n.sum()))].tobytes())
    return b"".join(out)


def codec(model: bytes) -> PieceCodec:
    """The worker's codec of a model; a reused worker keeps the last one."""
    cache, crc = worker_cache(), zlib.crc32(model)
    keep_for_task("piece codec")
    if cache.get("piece codec", (None,))[0] != crc:
        cache["piece codec"] = (crc, PieceCodec(model))
        gc.freeze()                              # the automaton's entries are not worth searching for cycles
    return cache["piece codec"][1]


def piece_model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def model_bytes(path: str | None) -> bytes:
    with open(path or piece_model_path(), "rb") as f:
        return f.read()


# ---------------------------------------------------------------- Spark jobs

def encode_texts(docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids) of every row, with the end id."""
    model = model_bytes(model_path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(model)
        for pdf in batches:
            texts = pdf["_text"].tolist()
            for a, b in pieces(texts, MOST_CHARS):
                ids = [np.append(c.encode(t), np.uint32(c.end_id)).astype(np.int32) for t in texts[a:b]]
                yield pd.DataFrame({id_col: pdf[id_col].iloc[a:b].reset_index(drop=True), "ids": pd.Series(ids, dtype=object)})

    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, ids array<int>"
    return docs.select(F.col(id_col), F.col(text_col).alias("_text")).mapInPandas(frugal(run), schema)


def decode_ids(coded: DataFrame, model_path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, text) of every row of ids; null ids give a null text."""
    model = model_bytes(model_path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(model)
        for pdf in batches:
            yield pd.DataFrame({id_col: pdf[id_col], "text": [None if x is None else c.decode(x) for x in pdf["_ids"]]})

    schema = f"`{id_col}` {coded.schema[id_col].dataType.simpleString()}, text string"
    return coded.select(F.col(id_col), F.col(ids_col).alias("_ids")).mapInPandas(frugal(run), schema)


def code_digests(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: each text is encoded, its
    ids are decoded again, and both are hashed in the same pass."""
    model = model_bytes(model_path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(model)
        for pdf in batches:
            n, ids_sha, text_sha = [], [], []
            for text in pdf["text"]:
                ids = np.append(c.encode(text), np.uint32(c.end_id))
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(c.ids_text(ids)).hexdigest())
                text_sha.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
            yield pd.DataFrame({"doc_id": pd.array(pdf["doc_id"], dtype="Int64"), "n_tokens": n, "ids_sha256": ids_sha, "decoded_sha256": text_sha})

    # ids as text: a null id would make the column floating
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    out = rows.mapInPandas(frugal(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out


def op11_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_digests(table(spark, sf_dir, "documents"))
