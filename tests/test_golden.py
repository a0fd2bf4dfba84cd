"""Golden edge cases (FIXTURES.md §5), one small literal input each."""

import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.functions import dates as DT
from ledgerlink.functions import json as JS
from ledgerlink.functions import text as TX
from ledgerlink.operators import catalogue as CT
from ledgerlink.operators import matching as MT
from ledgerlink.operators import money as MO
from ledgerlink.operators import relational as RL
from ledgerlink.plans import report


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")


def col_values(df, name="r"):
    return [r[name] for r in df.orderBy("i").collect()]


def test_emphasize(spark):
    d = one_col(spark, ["PC", None, ""])
    assert col_values(d.select("i", TX.emphasize("v").alias("r"))) == ["*PC*", "", ""]


def test_combine_keeps_double_blank(spark):
    d = spark.createDataFrame([("a", None, "c")], "a string, b string, c string")
    assert d.select(TX.combine_columns(["a", "b", "c"]).alias("r")).first()["r"] == "a  c"


def test_strip_digits(spark):
    d = one_col(spark, ["RAM 16GB x2", "x٣y"])           # Arabic-Indic 3 is a digit too
    assert col_values(d.select("i", TX.strip_digits("v").alias("r"))) == ["RAM GB x", "xy"]


def test_normalize_text(spark):
    d = one_col(spark, ["Éléments  chauffants\n (œuvre) ﬁltre m² ", "½ \U0001d400"])
    out = col_values(d.select("i", TX.normalize_text("v").alias("r")))
    assert out == ["Elements chauffants (uvre) filtre m2", "12 A"]


def test_rstrip_unicode(spark):
    d = one_col(spark, ["ab\t\n ", "  ab"])
    assert col_values(d.select("i", TX.rstrip_unicode("v").alias("r"))) == ["ab", "  ab"]


def test_hierarchical_select(spark):
    d = spark.createDataFrame([("dom", "fam", None)], "a string, b string, c string")
    assert d.select(TX.hierarchical_select(["a", "b", "c"]).alias("r")).first()["r"] == "fam"


def test_dropna_all(spark):
    d = spark.createDataFrame([(None, None), ("a", None)], "a string, b string")
    rows = RL.dropna_all(d, ["a", "b"]).collect()
    assert [(r["a"], r["b"]) for r in rows] == [("a", None)]


def test_apply_corrections(spark):
    src = spark.createDataFrame([("k1", "x"), ("k2", "x"), (None, "x")], "key string, val string")
    corr = spark.createDataFrame([("k1", None, "u"), ("k2", "y", "u"), (None, "z", "u")],
                                 "key string, val string, unknown string")
    out = {r["key"]: r["val"] for r in RL.apply_corrections(src, corr, "key").collect()}
    assert out == {"k1": "x", "k2": "y", None: "x"}


def test_parse_dates(spark):
    d = one_col(spark, ["03/02/2023", "2023-02-03", "31/02/2023"])
    out = col_values(d.select("i", DT.parse_date("v").alias("r")))
    assert [str(x) if x else None for x in out] == ["2023-02-03", None, None]


def test_half_even_two_decimals(spark):
    d = one_col(spark, [0.125, 0.135, 0.845, 0.025], "double")
    out = col_values(d.select("i", (F.bround(F.col("v") * 100, 0) / 100).alias("r")))
    assert out == [0.12, 0.14, 0.84, 0.02]


def test_money_chain(spark):
    lines = spark.createDataFrame([(1, "2023-02-10", "USD", 250.0, "c1")],
                                  "id int, d string, cur string, amt double, code string") \
        .withColumn("d", F.to_date("d"))
    rates = spark.createDataFrame([("2023-02-01", "USD", "EUR", 0.95)],
                                  "month string, currency string, target string, rate double") \
        .withColumn("month", F.to_date("month"))
    index = spark.createDataFrame([("2023-02-01", 115.5), ("2019-01-01", 105.0)], "month string, index double") \
        .withColumn("month", F.to_date("month"))
    cat = spark.createDataFrame([("c1", 0.4, 0.5, 0.25)], "code string, ef double, unc_attr double, unc_80 double")
    from ledgerlink.spec import JobSpec
    x = report.emissions_lines(lines, rates, index, cat, JobSpec(base_year=2019, second_currency="EUR"),
                               "code", "d", "cur", "amt").first()
    assert x["amount_eur"] == 237.5
    assert math.isclose(x["amount_deflated"], 215.9090909090909, rel_tol=1e-12)
    assert math.isclose(x["co2e"], 86.36363636363636, rel_tol=1e-12)
    assert math.isclose(x["total_uncertainty_factor"], 0.7, rel_tol=1e-12)
    assert math.isclose(x["uncertainty_carbon_emissions"], 60.45454545454545, rel_tol=1e-12)


def test_fx_fallbacks(spark):
    lines = spark.createDataFrame([(1, "EUR"), (2, "XOF"), (3, "GBP")], "id int, cur string") \
        .withColumn("d", F.to_date(F.lit("2023-02-10"))).withColumn("amt", F.lit(10.0))
    rates = spark.createDataFrame([], "month date, currency string, target string, rate double")
    out = {r["id"]: (r["rate_EUR"], r["fx_quarantined"])
           for r in MO.fx_convert(lines, rates, "d", "cur", "amt", "EUR").collect()}
    assert out == {1: (1.0, False), 2: (0.0015, False), 3: (None, True)}


def test_prefix_median(spark):
    codes = spark.createDataFrame(
        [("A", None), ("AA", None), ("AA1", None), ("AA11", None), ("B", None),
         ("AA11x", 1.0), ("AA12x", 3.0), ("AB11x", 10.0)], "code string, ef double")
    out = {r["code"]: r["ef"] for r in CT.prefix_median_impute(codes, "code", ["ef"], 5).collect()}
    assert out == {"A": 3.0, "AA": 2.0, "AA1": 2.0, "AA11": 1.0, "B": None,
                   "AA11x": 1.0, "AA12x": 3.0, "AB11x": 10.0}


def test_keep_first(spark):
    d = spark.createDataFrame([("k", 2, "second"), ("k", 1, "first")], "k string, o int, v string")
    assert RL.distinct_keep_first(d, ["k"], "o").first()["v"] == "first"


def test_repeated_catalogue_text_does_not_fan_out(spark):
    lines = spark.createDataFrame([(1, "a"), (2, "a")], "id int, code string")
    cat = spark.createDataFrame([("a", 0.1), ("a", 0.1)], "code string, ef double")
    assert report.attach_factors(lines, cat, "code").count() == 2


def test_rating(spark):
    d = one_col(spark, [1.0, 0.75, None, 0.1], "double")
    out = MT.flag_mismatches(d, "v").orderBy("i").collect()
    assert [r["Rating"] for r in out] == [5, 4, None, 1]
    assert [r["Flag"] for r in out] == [False, False, False, True]


def test_parse_choice_answers(spark):
    d = one_col(spark, ['{"0":{"ID":33,"Chosen option":"E"}}', "oops"])
    rows = JS.explode_answers(d, "v", JS.CHOICE_SCHEMA, ["i"]).orderBy("i").collect()
    assert (rows[0]["row_key"], rows[0]["answer"]["ID"], rows[0]["answer"]["Chosen option"]) == ("0", 33, "E")
    assert rows[1]["row_key"] is None and rows[1]["answer"] is None


def test_wrap_words(spark):
    d = one_col(spark, ["a b c d e f g", "", "a  b\tc"])
    assert col_values(d.select("i", TX.wrap_words("v", 3).alias("r"))) == ["a b c<br>d e f<br>g", "", "a b c"]


def test_share_label(spark):
    d = spark.createDataFrame([("a", 1 / 3)], "l string, s double")
    assert d.select(TX.share_label("l", "s").alias("r")).first()["r"] == "a (33.3%)"


def test_unknown_catalogue_name_lists_valid(spark):
    reg = spark.createDataFrame([("x", "c")], "catalogue string, category string")
    try:
        CT.select_catalogue(reg, "nope", ["x", "y"])
        raise AssertionError("expected an error")
    except ValueError as e:
        assert "x, y" in str(e)


def test_standardize_units_pencils(spark):
    rec = spark.createDataFrame([("pencils", "g", 3.0)], "Description string, unit string, value double")
    r = CT.standardize_units(rec, CT.unit_table(spark)).first()
    assert (r["unit"], r["value"], r["Geographical_scope"]) == ("kg", 0.003, "Global")


def test_roles_helpers(spark):
    from ledgerlink.operators import profile as PR
    roles = spark.createDataFrame([("date_column", "d"), ("unit_column", None)], "role string, column string")
    r = PR.roles_complete(roles).first()
    assert (r["complete"], r["n_missing"]) == (False, 1)
    assert PR.fill_roles({"date_column": "", "amount_column": "amt"}, roles) == \
        {"date_column": "d", "amount_column": "amt", "unit_column": None}


def test_cut_and_newline(spark):
    d = one_col(spark, ["a\nb" + "x" * 500])
    r = d.select(TX.cut_text(TX.newline_to_blank("v"), 400).alias("r")).first()["r"]
    assert r.startswith("a b") and len(r) == 400


def test_single_quoted_titles_keep_apostrophes(spark):
    # the reference replaced every ' by " before parsing, which breaks l'usine
    d = one_col(spark, ["[{'id': 1, 'title': \"l'usine\", 'description': 'd'}]"])
    r = d.select(JS.parse_json(F.col("v"), JS.TITLES_SCHEMA, single_quotes=True).alias("t")).first()["t"]
    assert r[0]["id"] == 1 and r[0]["title"] == "l'usine"


def test_physical_basis_skips_money(spark):
    from ledgerlink.spec import JobSpec
    lines = spark.createDataFrame([(1, "c1", 3.0)], "id int, code string, qty double") \
        .withColumn("d", F.to_date(F.lit("2023-02-10"))).withColumn("cur", F.lit("USD"))
    cat = spark.createDataFrame([("c1", 0.4, 0.5, 0.25)], "code string, ef double, unc_attr double, unc_80 double")
    empty = spark.createDataFrame([], "month date, currency string, target string, rate double")
    idx = spark.createDataFrame([], "month date, index double")
    r = report.emissions_lines(lines, empty, idx, cat, JobSpec(basis="physical"), "code", "d", "cur", "qty").first()
    assert math.isclose(r["co2e"], 1.2) and math.isclose(r["uncertainty_carbon_emissions"], 1.2 * 0.7)


def test_prefix_columns_and_result_view(spark):
    cat = spark.createDataFrame([("a", 0.1, "x")], "code string, ef double, description string")
    src = spark.createDataFrame([("a", "own")], "code string, description string")
    t = RL.prefix_columns(cat, "target.", keep=["code"])
    j = src.join(t, "code")
    assert j.columns == ["code", "description", "target.ef", "target.description"]
    v = RL.register_result_view(j, "ll_result")
    assert spark.sql("SELECT count(*) AS n FROM ll_result").first()["n"] == 1 and v.count() == 1


def test_unknown_catalogue_requests_get_error_rows(spark):
    reg = spark.createDataFrame([("agri", "x"), ("labo", "y")], "catalogue string, category string")
    req = spark.createDataFrame([(1, "labo"), (2, "nope")], "request_id int, database_name string")
    ok, bad = CT.split_requests(req, "database_name", reg)
    assert [r["request_id"] for r in ok.collect()] == [1]
    assert bad.first()["error"] == "no catalogue is called 'nope'; known ones: agri, labo"


def test_no_rates_or_index_passes_amounts_through(spark):
    from ledgerlink.spec import JobSpec
    lines = spark.createDataFrame([(1, "c1", 250.0)], "id int, code string, amt double") \
        .withColumn("d", F.to_date(F.lit("2023-02-10"))).withColumn("cur", F.lit("EUR"))
    cat = spark.createDataFrame([("c1", 0.4, 0.5, 0.25)], "code string, ef double, unc_attr double, unc_80 double")
    r = report.emissions_lines(lines, None, None, cat, JobSpec(), "code", "d", "cur", "amt").first()
    assert (r["amount_eur"], r["amount_deflated"]) == (250.0, 250.0) and math.isclose(r["co2e"], 100.0)
