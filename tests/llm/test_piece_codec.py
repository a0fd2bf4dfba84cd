import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlink.llm import piece_codec as P

TEXTS = ["Hello, world.  It's 12 o'clock...", "", None, " ", "   leading and   inner    blanks  ", "a\tb\r\nc\n\n d", "École à été ▁ ▁▁x<0x41></s><unk>",
         "日本語 テスト. ½ ß ﬁ İ 😀👩‍👩‍👧 \u0000 �", "x" * 3000 + " y" + " " * 300 + "z", "aaaaaaaaaaabababababab", "\n▁\n \n", "ee" * 40 + "en" * 31 + "the" * 9]


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=P.piece_model_path())


@pytest.fixture(scope="module")
def own():
    return P.PieceCodec(P.model_bytes(None))


def brute(library, doc_id, text):
    ids = library.encode(text or "") + [2]
    return (doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())


@pytest.mark.parametrize("text", TEXTS)
def test_ids_and_text_equal_the_librarys(own, library, text):
    ids = library.encode(text or "")
    assert own.encode(text).tolist() == ids
    assert own.decode(np.array(ids + [2])) == library.decode(ids + [2]) == (text or "").replace("▁", " ")


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet="aeinrst \n▁.é0", max_size=120)))
def test_any_text(own, library, text):
    assert own.encode(text).tolist() == library.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(3, 258), st.integers(0, 31999)), max_size=30))
def test_any_ids(own, library, ids):
    assert own.decode(np.array(ids, dtype=np.int64)) == library.decode(ids)


def test_uncut_texts_and_full_caches_change_nothing(own, library, monkeypatch):
    text = "The quick brown fox, jumped over  the lazy dog's back.\nÇa marche très bien." * 3
    whole = P.PieceCodec(P.model_bytes(None))
    whole.cut = None                                       # as of a model whose pieces hold blanks inside
    monkeypatch.setattr(P, "MOST_PARTS", 2)
    monkeypatch.setattr(P, "MOST_PAIRS", 3)
    assert whole.encode(text).tolist() == own.encode(text).tolist() == library.encode(text)


def test_each_prefix_ends_with_the_last_token_of_its_encoding(own, library):
    word = "▁internationalisationsprozesse"
    for n, token in enumerate(own.last_tokens(word), 1):
        assert token == library.encode(word[1:n], out_type=str)[-1] if n > 1 else token == "▁"


def test_compatible_pairs_are_those_that_stay_apart(own, library):
    rng = np.random.RandomState(1)
    names = [p for p in own.ids if not p.startswith("▁") and own.replay(p)]
    for a, b in rng.choice(names, (3000, 2)):
        assert own.compatible("▁" + a if "▁" + a in own.ids else a, b) in (True, False)
        if "▁" + a in own.ids and own.replay("▁" + a):
            assert own.compatible("▁" + a, b) == (library.encode(a + b, out_type=str) == ["▁" + a, b])


def test_defined_cases(spark, library):
    rows = [(i, t, 9) for i, t in enumerate(TEXTS)] + [(None, "no id", 1), (3, "again", 1), (3, "again", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(map(tuple, P.code_digests(df).collect()), key=key) == sorted([brute(library, i, t) for i, t, _ in rows], key=key)
    assert P.code_digests(df.limit(0)).count() == 0
    back = P.decode_ids(P.encode_texts(df)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in back) == sorted((i is None, i or 0, (t or "").replace("▁", " ")) for i, t, _ in rows)
    assert P.decode_ids(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).collect()[0].text is None


def test_other_models_are_refused(tmp_path):
    with pytest.raises(Exception):
        P.PieceCodec(b"no model")


def test_whole_table(spark, qs, library):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = sorted(map(tuple, qs["op11_piece_codec"](spark, sf).collect()))
    assert got == sorted(brute(library, r.doc_id, r.text) for r in docs)
