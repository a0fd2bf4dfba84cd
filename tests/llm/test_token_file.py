import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlink.llm import token_file as T


def brute(rows):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(T.word_tokenizer_path())
    out, start = [], 0
    for doc_id, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


TEXTS = ["Hello, world. It's 12 o'clock...", "", None, "a\tb\r\nc  d e", "École À bientôt, ÉTÉ. l'été 'S 'll",
         "x" * 5000 + " y", "<|endoftext|> <|startoftext|>z", "日本語 テスト. ½ ß ﬁ İstanbul ǅ", "a., b,. c.d ,e. ...", "é ́x İ. K."]


def test_digest_equals_plain_encoding(spark):
    rows = [(i * 7 % 11, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame([(i, t, 9) for i, t in rows], "doc_id long, text string, n_tokens int")
    got = [tuple(r) for r in T.token_digest(df, segment_tokens=20).orderBy("start").collect()]
    assert got == brute(sorted(rows, key=lambda r: r[0]))


def test_null_id_repeated_rows_and_empty_table(spark):
    rows = [(None, "b c"), (3, "same"), (3, "same"), (1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in T.token_digest(df).orderBy("start").collect()]
    assert got == brute([(None, "b c"), (1, None), (3, "same"), (3, "same")])
    assert T.token_digest(df.limit(0)).count() == 0


def test_whole_table(spark, qs):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    got = [tuple(r) for r in qs["op1_token_files"](spark, sf).orderBy("start").collect()]
    assert got == brute([(r.doc_id, r.text) for r in docs])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=1500))
def test_random_access(tmp_path_factory, ids):
    path = str(tmp_path_factory.mktemp("dac") / "seg.dac")
    arr = np.array(ids, dtype="<u4")
    with open(path, "wb") as f:
        f.writelines(T.segment_bytes([5], np.array([len(ids)]), arr))
    seg = T.Segment(path)
    assert seg.tokens(0, len(ids)).tolist() == ids
    for i in {0, len(ids) // 2, len(ids) - 1}:
        assert seg.token(i) == ids[i]
    a, b = len(ids) // 3, len(ids) // 3 * 2 + 1
    assert seg.tokens(a, b).tolist() == ids[a:b]
    with pytest.raises(IndexError):
        seg.token(len(ids))
