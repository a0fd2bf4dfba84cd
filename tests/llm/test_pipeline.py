import zlib

import numpy as np

import corpus_pipeline as C
from ledgerlink.llm import toxicity
from tests.llm import test_decontaminate, test_near_dup

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    from tokenizers import Tokenizer

    from ledgerlink.llm.token_file import word_tokenizer_path
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    steps = dict(C.STAGES)

    kept = steps["toxicity"](spark, docs, SF)
    scores = {r.doc_id: r.score for r in toxicity.toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    ids = sorted(r.doc_id for r in kept.collect())
    assert kept.columns == docs.columns and ids == sorted(d for d, s in scores.items() if s < toxicity.CUT)

    one = steps["near_duplicates"](spark, docs, SF)
    want = [d for d, _, _, k in test_near_dup.brute(list(text.items())) if k]
    assert one.columns == docs.columns and sorted(r.doc_id for r in one.collect()) == sorted(want)

    clean = steps["decontamination"](spark, docs, SF)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = [r[0] for r in test_decontaminate.brute(list(text.items()), items) if not r[-1]]
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == sorted(want)

    mixed = steps["mixing"](spark, docs, SF)
    rows = mixed.collect()
    assert mixed.columns == docs.columns and {r.doc_id for r in rows} <= set(text) and all(text[r.doc_id] == r.text for r in rows)
    tokens = {}
    for r in rows:
        tokens[r.lang] = tokens.get(r.lang, 0) + len(r.text.split())
    assert len(rows) > 0.95 * len(text)

    tok = Tokenizer.from_file(word_tokenizer_path())
    out = steps["token_files"](spark, clean, SF).collect()
    for r in out:
        n = tok.encode(text[r.doc_id], add_special_tokens=False).ids + [2]
        assert (r.n_tokens, r.ids_crc32) == (len(n), zlib.crc32(np.array(n, "<u4").tobytes()))
    assert sorted(r.doc_id for r in out) == sorted(want)


def test_run_and_empty_table(spark):
    rows = C.run(spark, SF).collect()
    assert 0 < len(rows) <= 400
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, apply in C.STAGES:
        assert apply(spark, docs, SF).count() == 0


def test_rows_without_id_stay(spark):
    docs = spark.createDataFrame([(None, "a b c d e f", "en", "s", 11), (1, "a b c d e f", "en", "s", 11), (2, "a b c d e f", "en", "s", 11), (3, None, None, None, None)],
                                 "doc_id long, text string, lang string, source string, n_chars int")
    assert sorted((r.doc_id for r in C.drop_near_duplicates(spark, docs, SF).collect()), key=str) == [1, 3, None]


def test_each_row_gets_its_own_decision(spark, tmp_path):
    def text(seed):
        return " ".join(f"{seed}{i}" for i in range(30))
    item = text("bench")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(None, text("a")), (None, text("a")), (None, text("b")), (None, item + " x"), (5, text("c")), (5, text("c")), (5, text("d")), (5, item + " y"),
            (12, text("d")), (3, text("c") + " z"), (7, None), (7, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one = sorted((tuple(r) for r in C.drop_near_duplicates(spark, docs, "").collect()), key=str)
    # "c" stays once, as row 3; "d" as row 5; "a" and the passage (near copies) once without an id and, the passage, once with
    assert one == sorted([(None, text("a")), (None, text("b")), (None, item + " x"), (5, text("d")), (5, item + " y"), (3, text("c") + " z"), (7, None), (7, None), (None, "")], key=str)
    clean = sorted((tuple(r) for r in C.drop_contaminated(spark, docs, str(tmp_path)).collect()), key=str)
    assert clean == sorted([r for r in rows if not (r[1] or "").startswith(item)], key=str)
    same = spark.createDataFrame([(4, text("e"))] * 50, "doc_id long, text string")
    assert C.drop_near_duplicates(spark, same, "").count() == 1


def test_passages_without_id_are_found(spark, tmp_path):
    item = " ".join(f"bench{i}" for i in range(20))
    spark.createDataFrame([(None, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(1, f"so {item} end"), (2, "clean words")], "doc_id long, text string")
    assert [r.doc_id for r in C.drop_contaminated(spark, docs, str(tmp_path)).collect()] == [2]
