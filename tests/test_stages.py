"""Stages that are computed once, through kills, repeats and races."""

import pytest
from pyspark.sql import functions as F

from ledgerlink.operators import embed as EM
from ledgerlink.operators import stages as ST


def texts_of(spark, words):
    return spark.createDataFrame([(w,) for w in words], "text string")


class Counting:
    """A user embedder that notes every text it embeds, in a file per call."""

    def __init__(self, folder, bad=None):
        self.folder, self.bad = str(folder), bad
        folder.mkdir(exist_ok=True)

    def __call__(self, texts):
        folder, bad = self.folder, self.bad

        def fn(series):
            import uuid
            if bad is not None and bad in set(series):
                raise RuntimeError("killed")
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.writelines(t + "\n" for t in series)
            return [[float(len(t)), float(sum(map(ord, t)))] for t in series]
        return EM.user_vectors(texts, fn)

    def embedded(self):
        import pathlib
        return sorted(x for f in pathlib.Path(self.folder).iterdir() for x in f.read_text().splitlines())


def test_fingerprint_knows_rows_but_not_their_order(spark):
    rows = [(i, None if i % 3 else f"t{i}", [float(i)]) for i in range(50)]
    df = spark.createDataFrame(rows, "i long, t string, v array<double>")
    other = spark.createDataFrame(rows[::-1], df.schema).repartition(7)
    assert ST.fingerprint(df) == ST.fingerprint(other)
    seen = {ST.fingerprint(x) for x in (df, df.union(df.limit(1)), df.filter("i < 49"), df.withColumnRenamed("t", "u"), df.withColumn("i", F.col("i") + 1),
                                        df.limit(0), spark.createDataFrame([("a", None)], "x string, y string"), spark.createDataFrame([(None, "a")], "x string, y string"))}
    assert len(seen) == 8


def test_a_stage_is_computed_once_per_input_version_and_parameters(spark, tmp_path):
    store, calls = ST.StageStore(spark, str(tmp_path / "s")), []

    def compute(df):
        calls.append(1)
        return df.select((F.col("id") * 2).alias("two"))

    run = lambda n=5, version="1", **p: sorted(r[0] for r in store.reuse("double", [spark.range(n).repartition(3)], compute, version, p).collect())
    assert run() == run() == [0, 2, 4, 6, 8] and len(calls) == 1
    assert run(6)[-1] == 10 and len(calls) == 2
    assert run(version="2") == run(version="2", model="m") == run() and len(calls) == 4


def test_a_killed_run_leaves_nothing_that_counts(spark, tmp_path):
    store = ST.StageStore(spark, str(tmp_path / "s"))

    def fails(df):
        return df.select(F.when(F.col("id") == 3, F.raise_error("killed")).otherwise(F.col("id")).alias("x"))

    with pytest.raises(Exception):
        store.reuse("st", [spark.range(5)], fails, "1")
    (tmp_path / "s" / "st").mkdir(parents=True, exist_ok=True)
    (tmp_path / "s" / "st" / "_manifest-dead").write_text("{half a man")
    assert store.manifests("st") == {}
    assert store.reuse("st", [spark.range(5)], lambda d: d, "1").count() == 5
    assert store.sweep("st") >= 1
    assert store.reuse("st", [spark.range(5)], fails, "1").count() == 5          # committed: not computed again


def test_the_first_commit_of_a_key_counts(spark, tmp_path):
    store = ST.StageStore(spark, str(tmp_path / "s"))
    first = store.commit("st", "k", spark.range(3))
    second = store.commit("st", "k", spark.range(9))
    assert (first[1], second[1]) == (True, False) and second[0] == first[0]
    assert store.load(second[0]).count() == 3
    assert len([f for f in (tmp_path / "s" / "st").iterdir() if f.name.startswith("_data")]) == 1


def test_only_new_texts_are_embedded(spark, tmp_path):
    words = [f"word {i}" for i in range(40)]
    model = Counting(tmp_path / "calls")
    for n in (25, 25, 40, 40):
        got = EM.embed_cached(texts_of(spark, words[:n] * 2), str(tmp_path / "c"), "m", model)
        assert sorted((r.text, r.embedding[0]) for r in got.collect()) == sorted((w, float(len(w))) for w in words[:n])
    assert model.embedded() == sorted(words)
    EM.embed_cached(texts_of(spark, words[:2]), str(tmp_path / "c"), "m", model, version="2").count()
    assert len(model.embedded()) == 42                       # another version of the model: another cache


def test_a_killed_embedding_keeps_its_committed_parts(spark, tmp_path):
    words = [f"text {i}" for i in range(60)]
    with pytest.raises(Exception):
        EM.embed_cached(texts_of(spark, words), str(tmp_path / "c"), "m", Counting(tmp_path / "a", bad="text 7"), parts=6)
    kept = EM.cached_vectors(spark, str(tmp_path / "c"), "m")
    done = set() if kept is None else {r.text for r in kept.collect()}
    assert "text 7" not in done
    model = Counting(tmp_path / "b")
    got = EM.embed_cached(texts_of(spark, words), str(tmp_path / "c"), "m", model, parts=6)
    assert sorted(r.text for r in got.collect()) == sorted(words)
    assert model.embedded() == sorted(set(words) - done)


def test_segments_that_overlap_count_once(spark, tmp_path):
    path = str(tmp_path / "c")
    assert EM.write_cache(EM.char_profile_vectors(texts_of(spark, ["a", "b"])), path, "m")
    assert EM.write_cache(EM.char_profile_vectors(texts_of(spark, ["b", "c"])), path, "m")      # as of a run at the same time
    assert not EM.write_cache(EM.char_profile_vectors(texts_of(spark, ["b", "a"])), path, "m")
    every, new = EM.merge_with_cache(texts_of(spark, ["a", "b", "c", "d"]), path, "m", EM.char_profile_vectors)
    assert sorted((r.text, r.from_cache) for r in every.collect()) == [("a", True), ("b", True), ("c", True), ("d", False)]
    assert [r.text for r in new.collect()] == ["d"]
    assert EM.cached_vectors(spark, path, "other model") is None


def test_no_texts(spark, tmp_path):
    assert EM.embed_cached(texts_of(spark, []), str(tmp_path / "c"), "m", EM.char_profile_vectors).count() == 0


def test_distinct_texts_are_normalised_once_and_never_sorted(spark):
    df = spark.createDataFrame([(1, "Ä  b"), (2, "A b"), (3, None), (4, "c")], "id int, t string")
    out = EM.embed_distinct(df, "t", EM.char_profile_vectors)
    assert out.columns == ["id", "t", "embedding"]
    got = {r.id: r.embedding for r in out.collect()}
    assert got[1] == got[2] and got[3] is None and got[4][2] == 1.0
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
