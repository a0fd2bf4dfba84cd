"""M8: phrases by leftmost-longest matching, against a plain scan."""

import random

import pytest

from ledgerlink.operators import translate as TR


def plain(text, glossary):
    if text is None:
        return None
    tokens, out, i = text.split(" "), [], 0
    while i < len(tokens):
        for n in range(len(tokens) - i, 0, -1):
            key = " ".join(tokens[i:i + n]).lower()
            if key in glossary:
                out.append(glossary[key])
                i += n
                break
        else:
            out.append(tokens[i])
            i += 1
    return " ".join(out)


def frame(spark, glossary):
    return spark.createDataFrame(glossary, "source string, target string")


@pytest.mark.parametrize("most", [1_000_000, 2])
def test_overlapping_phrases(spark, most):
    rng = random.Random(1)
    glossary = {"a": "1", "a b": "2", "b a": "3", "a b c": "4", "c c": "5", "b": "6", "d e f g": "7", "e": "8"}
    texts = [" ".join(rng.choice(["a", "A", "b", "c", "d", "e", "f", "g", ""]) for _ in range(rng.randint(0, 30))) for _ in range(150)] + [None, "", "d e f", "D E F G"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts * 2)], "id int, t string, pos string")
    out = TR.translate_phrases(df, ["t"], frame(spark, sorted(glossary.items())), max_broadcast_rows=most)
    assert sorted(out.columns) == ["id", "pos", "t", "t original"]
    assert {r["id"]: (r["t original"], r["t"]) for r in out.collect()} == {i: (t, plain(t, glossary)) for i, t in enumerate(texts * 2)}


def test_single_words_translate_as_before(spark):
    g = frame(spark, [("le", "the"), ("chat", "cat")])
    df = spark.createDataFrame([(1, "Le chat  noir"), (2, None), (3, "rien")], "id int, t string")
    rows = [sorted((r["id"], r["t"], r["t original"]) for r in f(df, ["t"], g).collect()) for f in (TR.translate_phrases, TR.translate_columns)]
    assert rows[0] == rows[1]


def test_glossary_edges(spark):
    df = spark.createDataFrame([(1, "a b")], "id int, t string")
    for g, want in (([], "a b"), ([(None, "x"), ("a", None)], "a b"), ([("A B", "y"), ("a b", "x")], "x"), ([("", "x")], "a b")):
        assert TR.translate_phrases(df, ["t"], frame(spark, g)).first()["t"] == want


def test_small_glossaries_hash_no_run_and_crowded_heads_match_as_well(spark, monkeypatch):
    texts = spark.createDataFrame([(str(i), t) for i, t in enumerate(["a b c a", "A  b", "", "b c a b c"])], "_h string, _text string")
    g = frame(spark, [("a", "1"), ("a b", "2"), ("a b c", "3"), ("", "4"), ("c A b", "5")])
    few = TR.phrase_matches(texts, g)
    assert "md5(" not in few._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(TR, "MOST_OF_HEAD", 2)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, TR.phrase_matches(texts, g).collect()))


def test_two_columns(spark):
    df = spark.createDataFrame([(1, "a b", "b a")], "id int, t string, u string")
    out = TR.translate_phrases(df, ["t", "u"], frame(spark, [("a b", "x"), ("b", "y")])).first().asDict()
    assert out == {"id": 1, "t": "x", "t original": "a b", "u": "y a", "u original": "b a"}
