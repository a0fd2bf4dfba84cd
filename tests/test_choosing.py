"""Choosers that fail, answers that are kept, options with texts."""

import pathlib
import uuid

from ledgerlink.operators import choosing as CH
from ledgerlink.operators import embed as EM


def candidates(spark, n, ids=("B", "A")):
    rows = [(f"q{i:03d}", f"text {i}", list(ids), ["wide", "narrow option"], [0.5, 0.5]) for i in range(n)]
    return spark.createDataFrame(rows, "q_id string, text string, cand_ids array<string>, cand_texts array<string>, cand_scores array<double>")


class Noting:
    """A chooser, ``fn``, that notes what it was asked; a closure, as it travels to the workers."""

    def __init__(self, folder, most=10 ** 9, bad=(), answer="A"):
        folder.mkdir(exist_ok=True)
        self.folder = folder = str(folder)
        bad = set(bad)

        def fn(pdf):
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write("\n".join(map(str, pdf["q_id"])))
            if len(pdf) > most or bad & set(pdf["q_id"]):
                raise RuntimeError("no answer")
            return [answer] * len(pdf)
        self.fn = fn

    def asked(self):
        return [f.read_text().split("\n") for f in pathlib.Path(self.folder).iterdir()]


def test_failing_batches_are_halved_and_one_bad_row_costs_itself(spark, tmp_path):
    fn = Noting(tmp_path / "n", most=12, bad=["q007"]).fn
    answers, attempts = CH.choose_in_rounds(candidates(spark, 40), fn, budget=120)       # 6 tokens a row
    assert sorted(r.q_id for r in answers.collect()) == [f"q{i:03d}" for i in range(40) if i != 7]
    rows = attempts.collect()
    first = {r.q_id for r in rows if r["round"] == 0}
    assert len(first) == 40 and all(r.error for r in rows if r["round"] == 0)
    assert [r.error for r in rows if r["round"] == 3] and all(r.q_id in {"q007"} for r in rows if r["round"] == 3 and r.error)
    assert max(len({r.q_id for r in rows if r["round"] == 1 and r.batch_id == b}) for b in {r.batch_id for r in rows if r["round"] == 1}) <= 10
    assert len([1 for r in rows if r.q_id == "q007"]) == 4


def test_an_answer_that_is_no_candidate_is_asked_again_and_stays_open(spark, tmp_path):
    answers, attempts = CH.choose_in_rounds(candidates(spark, 3), Noting(tmp_path / "n", answer="Z").fn, budget=100, rounds=2)
    assert answers.count() == 0 and {r.error for r in attempts.collect()} == {"not a candidate"} and attempts.count() == 6


def test_a_repeated_run_asks_nothing_again(spark, tmp_path):
    folder = str(tmp_path / "kept")
    one, two = Noting(tmp_path / "a", most=5), Noting(tmp_path / "b", most=5)
    first = sorted(map(tuple, CH.choose_in_rounds(candidates(spark, 12), one.fn, 60, folder=folder)[0].collect()))
    again = sorted(map(tuple, CH.choose_in_rounds(candidates(spark, 12).repartition(5), two.fn, 60, folder=folder)[0].collect()))
    assert first == again and len(first) == 12 and two.asked() == []
    assert len(sorted(map(tuple, CH.choose_in_rounds(candidates(spark, 12), two.fn, 60, folder=folder, version="2")[0].collect()))) == 12
    assert two.asked()


def test_integer_ids_and_no_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, "t", [10, 20], ["a", "b"], [0.1, 0.2])], "q_id long, text string, cand_ids array<long>, cand_texts array<string>, cand_scores array<double>")
    answers, _ = CH.choose_in_rounds(df, Noting(tmp_path / "n", answer=20).fn, 10)
    assert [tuple(r) for r in answers.collect()] == [(1, 20)]
    assert CH.choose_in_rounds(df.limit(0), Noting(tmp_path / "n").fn, 10)[0].count() == 0


def test_broad_options_are_preferred(spark):
    pdf = candidates(spark, 1).toPandas()
    assert CH.weighted_chooser(1.0, 0.0, 0.0)(pdf) == ["A"]          # equal scores: the lower id
    assert CH.weighted_chooser(1.0, 0.0, 0.2)(pdf) == ["B"]          # one word against two


def test_rows_without_text_or_answer_stay(spark, tmp_path):
    rows = spark.createDataFrame([(1, "paper clips"), (2, None), (3, "paper clips"), (4, "refused")], "id int, t string")
    cat = spark.createDataFrame([("x", "clips of paper"), ("y", "zebra"), ("z", None)], "code string, d string")

    def choose(pdf):
        if (pdf["text"] == "refused").any():
            raise RuntimeError
        assert all(isinstance(x, str) for o in pdf["cand_texts"] for x in o)
        return [i[0] for i in pdf["cand_ids"]]

    out = CH.match_with_chooser(rows, "t", cat, "code", "d", EM.char_profile_vectors, choose, 2, 100, folder=str(tmp_path / "f"), model="m")
    assert out.columns == ["id", "t", "match_id", "match_similarity"]
    assert {r.id: r.match_id for r in out.collect()} == {1: "x", 2: None, 3: "x", 4: None}
