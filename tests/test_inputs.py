"""Legal inputs at the edges of the operators: repeated keys, nulls, negative
scores, typed dates, equal vectors, quoted text."""

import math
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlink import session
from ledgerlink.functions import dates as DT
from ledgerlink.operators import clusters as CL
from ledgerlink.operators import embed as EM
from ledgerlink.operators import matching as MT
from ledgerlink.operators import money as MO
from ledgerlink.operators import relational as RL
from ledgerlink.operators import similarity as SIM
from ledgerlink.operators import translate as TR
from ledgerlink.plans import report
from ledgerlink.sources import files as FS
from ledgerlink.spec import JobSpec


def test_rating_of_a_negative_score(spark):
    r = MT.flag_mismatches(spark.createDataFrame([(-0.2,)], "v double"), "v").first()
    assert (r["Rating"], r["Flag"]) == (1, True)


def test_repeated_correction_with_a_null(spark):
    src = spark.createDataFrame([("k", "x", "p")], "key string, val string, other string")
    corr = spark.createDataFrame([("k", "y", None), ("k", None, "q")], "key string, val string, other string")
    assert tuple(RL.apply_corrections(src, corr, "key").first()) == ("k", "y", "q")


def test_repeated_catalogue_code_with_a_null_factor(spark):
    cat = spark.createDataFrame([("c", None, "a"), ("c", 0.4, "b")], "code string, ef double, text string")
    assert tuple(report.attach_factors(spark.createDataFrame([("c",)], "code string"), cat, "code").first()) == ("c", 0.4, "b")


def test_repeated_and_missing_index_months(spark):
    index = spark.createDataFrame([("2023-02-01", 110.0), ("2023-02-01", 110.0), ("2019-01-01", 100.0)], "month string, index double").withColumn("month", F.to_date("month"))
    lines = spark.createDataFrame([(1, "2023-02-10", 11.0), (2, "2023-03-10", 11.0)], "id int, d string, amt double").withColumn("d", F.to_date("d"))
    rows = {r["id"]: (r["out"], r["deflate_quarantined"]) for r in MO.deflate(lines, index, "d", "amt", 2019, "out").collect()}
    assert len(rows) == 2 and math.isclose(rows[1][0], 10.0) and rows[1][1] is False and rows[2] == (None, True)


def test_dates_and_timestamps_pass_through(spark):
    df = spark.sql("SELECT DATE'2023-02-03' AS d, TIMESTAMP'2023-02-03 23:59:59' AS t, '03/02/2023' AS s, '2023-02-03' AS wrong")
    r = df.select(*[DT.parse_date(x).alias(x) for x in df.columns]).first()
    assert [str(x) if x else None for x in r] == ["2023-02-03"] * 3 + [None]


def _line(spark):
    lines = spark.createDataFrame([(1, "2023-02-10", "GBP", 20.0, "c", "g")], "id int, d string, cur string, amt double, code string, grp string").withColumn("d", F.to_date("d"))
    return lines, spark.createDataFrame([("c", 0.1, 0.5, 0.25)], "code string, ef double, unc_attr double, unc_80 double")


@pytest.mark.parametrize("basis", ["physical", "money"])
def test_summary_without_rates_or_index(spark, basis):
    lines, cat = _line(spark)
    spec = JobSpec(basis=basis)
    s = report.emissions_summary(lines, None, None, cat, spec, "code", "d", "cur", "amt", ["grp"]).first()
    one = report.emissions_lines(lines, None, None, cat, spec, "code", "d", "cur", "amt").first()
    assert s["co2e_kg"] == 2.0 == one["co2e"] and s["n_quarantined"] == 0


def test_every_row_of_a_small_cluster_represents_it(spark):
    rows = [(i, 1, [1.0, 2.0]) for i in range(3)] + [(3, 1, [5.0, 5.0])] + [(10 + i, 2, [float(i % 4), 0.0]) for i in range(40)]
    out = CL.subcluster_representatives(spark.createDataFrame(rows, "id long, cl long, v array<double>"), "id", "v", "cl", k_sub=10, iters=2).collect()
    assert sorted(r["id"] for r in out if r["cl"] == 1) == [0, 1, 2, 3]
    assert 1 <= sum(r["cl"] == 2 for r in out) <= 10


def test_cache_written_twice(spark, tmp_path):
    texts = spark.createDataFrame([("a",), ("b",)], "text string")
    path = str(tmp_path / "cache")
    for _ in range(2):
        EM.write_cache(EM.char_profile_vectors(texts), path, "m")
    every, new = EM.merge_with_cache(texts, path, "m", EM.char_profile_vectors)
    assert every.count() == 2 and new.count() == 0
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.parquet").write_text("not a table")
    with pytest.raises(Exception):
        EM.merge_with_cache(texts, str(tmp_path / "broken"), "m", EM.char_profile_vectors)[0].count()


def test_csv_with_separators_and_quotes(spark, tmp_path):
    rows = [(1, 'a, "b"'), (2, "plain"), (3, '"')]
    FS.write_csv_with_preamble(spark.createDataFrame(rows, "id int, t string"), str(tmp_path / "c"), ["x", "y"])
    back = FS.read_csv_skip_preamble(spark, str(tmp_path / "c"), skip=2)
    assert sorted((int(r["id"]), r["t"]) for r in back.collect()) == rows


def test_both_translation_forms_give_the_same_text(spark):
    g = spark.createDataFrame([("le", "the"), ("le", "THE"), ("chat", "cat"), (None, "x")], "source string, target string")
    df = spark.createDataFrame([(1, "Le chat  noir"), (2, None)], "id int, t string")
    forms = [sorted((r["id"], r["t"], r["t original"]) for r in TR.translate_columns(df, ["t"], g, max_map_entries=n).collect()) for n in (256, 0)]
    assert forms[0] == forms[1] == [(1, "THE cat  noir", "Le chat  noir"), (2, None, None)]


def test_chooser_keeps_text_ids_and_only_failing_rows_fail(spark):
    c = spark.createDataFrame([("q1", ["EC17x", "B"]), ("q2", ["B"]), ("bad", ["B"])], "q_id string, cand_ids array<string>")

    def pick(pdf):
        if (pdf["q_id"] == "bad").any():
            raise ValueError("no answer")
        return pdf["cand_ids"].map(lambda x: x[0])

    assert dict(map(tuple, MT.user_choose(c, pick).collect())) == {"q1": "EC17x", "q2": "B", "bad": None}


def _vectors(spark, n, groups, seed, first=0):
    rng = np.random.RandomState(seed)
    return spark.createDataFrame([(first + i, rng.randint(-2, 3, 4).astype(float).tolist(), groups[i % len(groups)]) for i in range(n)], "id long, v array<double>, g string")


def test_both_forms_of_the_similarity_join_give_the_same_rows(spark):
    q = _vectors(spark, 60, ["a", "b", None], 1).unionByName(_vectors(spark, 4, ["b", "c"], 2))      # ids 0-3 in two groups
    t = _vectors(spark, 90, ["a", None, "b", "c"], 3, first=1000)
    forms = [sorted(map(tuple, SIM.topk_cosine(q, t, 3, "id", "v", "id", "v", "g", "g", mode=m, block_rows=b).collect()))
             for m, b in (("broadcast", None), ("blocked", None), ("blocked", 7))]
    assert forms[0] == forms[1] == forms[2] and forms[0]                     # equal to the last bit
    nulls = {r["id"] for r in q.where("g IS NULL").collect()} - {0, 1, 2, 3}
    assert not nulls & {r[0] for r in forms[0]}


def test_kernel_equals_a_full_sort_and_needs_little_memory():
    rng = np.random.RandomState(0)
    q, t = rng.randint(-1, 2, (1500, 6)).astype(float), rng.randint(-1, 2, (9000, 6)).astype(float)
    ids = rng.permutation(9000)
    tracemalloc.start()
    s, i = SIM.topk_block(np.arange(1500), q, None, ids, t, None, 10, False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6
    full = SIM._rank_key(SIM._unit_rows(q[:50]) @ SIM._unit_rows(t).T)
    for r in range(50):
        assert i[r].tolist() == ids[np.lexsort((ids, -full[r]))[:10]].tolist()


def test_equal_values_do_not_meet_in_one_partition(spark):
    df = spark.range(60_000).select(F.lit("k").alias("k"), F.when(F.col("id") % 3 > 0, 7.0).otherwise(F.col("id").cast("double")).alias("v"))
    g = RL.global_order_index(df.withColumn("_u", F.monotonically_increasing_id()), ["k", "v", "_u"], num_partitions=8)
    sizes = [r["count"] for r in g.groupBy(F.floor(F.col("_gidx") / 7500)).count().collect()]
    assert sum(sizes) == 60_000
    ordered = df.withColumn("_u", F.monotonically_increasing_id()).repartitionByRange(8, "k", "v", "_u")
    parts = [r["count"] for r in ordered.groupBy(F.spark_partition_id()).count().collect()]
    assert max(parts) < 2 * 60_000 / 8
    assert RL.exact_median_by(df, "k", "v").first()["median"] == 7.0


def test_a_grown_table_is_measured_again(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    assert session.bounded_rows(spark.read.parquet(path), 10) == 3
    spark.range(100).write.mode("append").parquet(path)
    assert session.bounded_rows(spark.read.parquet(path), 10) == 11


def test_broadcast_is_bounded_by_bytes(spark):
    df = spark.createDataFrame([(1, "x" * 1000, [1.0] * 50)], "id int, t string, v array<double>")
    rows, size = session.bounded_size(df, 10)
    assert rows == 1 and 1400 <= size <= 1500
    big = session.bounded_broadcast(df, 10, max_bytes=100)
    assert "broadcast" not in big._jdf.queryExecution().logical().toString().lower()


def test_content_key_has_all_bits(spark):
    assert len(spark.range(1).select(RL.content_key(["id"])).first()["sk"]) == 32


def test_released_stages_leave_nothing(spark):
    df = session.materialize(spark.range(3), "released")
    path = df.inputFiles()[0].rsplit("/", 1)[0]
    assert df.count() == 3 and session.path_exists(spark, path)
    assert session.release_stages(spark) >= 1 and not session.path_exists(spark, path)


def test_roles_scan_the_profile_once(spark, qs):
    plan = qs["infer_roles"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") <= 5 and "BroadcastNestedLoopJoin" not in plan     # each source table once
