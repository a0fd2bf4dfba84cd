"""Secrets: pattern spans, and strings that pass a battery of randomness tests.

Base spans are assignments to password-like names, access key ids and long hex
strings. Candidates of the method are runs of at least ``SHORTEST`` characters of
[A-Za-z0-9+/_=-] with a digit and a letter. The smallest of the usual encodings
that a run fits (hex, base32, letters and digits, base64, base64url) gives its
alphabet, and three tests ask whether its symbols could be drawn at random:
chi-squared uniformity over the alphabet, runs above and below its middle, and
serial correlation. Fisher's method combines the three p-values.

Random strings have evenly spread combined p-values, others mostly tiny ones. So
in each class of encoding and length the number of random strings follows from
the p-values above 0.5, and with it the share of false finds among all strings
above a threshold. The class takes the lowest threshold whose estimated share of
false finds is at most ``FALSE_SHARE``: short strings, on which the tests say
little, get a higher one. The estimate counts distinct strings; the threshold
holds for every occurrence. (``ORACLE`` counts occurrences and so has the same
rows only where no candidate is repeated.)

All of it is DataFrame functions and one pass over whole texts; the classes are
a few dozen rows. Defined cases: a null or empty text has no spans; repeated
rows stay; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlink.llm.common import Stages, table
from ledgerlink.llm.spans import SPAN, overlaps, with_spans

SHORTEST = 20
FALSE_SHARE = 0.1
CELLS = 50
KINDS = ("assign", "access", "hex")

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# Runs of a class are maximal, so a least length in the pattern drops exactly the shorter ones.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
RUN = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{SHORTEST},}}"

_UPPER, _LOWER, _DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: name, what the whole run has to match, alphabet in order.
ENCODINGS = (
    ("hex", "^[0-9a-f]+$", _DIGIT + "abcdef"),
    ("HEX", "^[0-9A-F]+$", _DIGIT + "ABCDEF"),
    ("base32", "^[A-Z2-7]+=*$", _UPPER + "234567"),
    ("base36", "^[a-z0-9]+$", _LOWER + _DIGIT),
    ("alnum", "^[A-Za-z0-9]+$", _UPPER + _LOWER + _DIGIT),
    ("base64", "^[A-Za-z0-9+/]+=*$", _UPPER + _LOWER + _DIGIT + "+/"),
    ("base64url", "^[A-Za-z0-9_-]+=*$", _UPPER + _LOWER + _DIGIT + "-_"),
)


def base_spans(docs: DataFrame) -> DataFrame:
    """Adds the base span columns to rows with ``text``."""
    low = F.lower("text")
    named = (low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("api")) & (F.col("text").contains("=") | F.col("text").contains(":"))
    df = with_spans(docs, "assign", ASSIGN, named, lambda v: F.char_length(F.regexp_extract(v, "^" + ASSIGN + "$", 2)) >= 8)
    df = with_spans(df, "access", ACCESS, F.col("text").contains("AKIA"), lambda v: F.lit(True))
    return with_spans(df, "hex", HEX, F.col("text").rlike(HEX), lambda v: F.lit(True))


def upper_tail(z: Column) -> Column:
    """1 - Phi(z), by the rational approximation with error below 1e-7."""
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.2316419) * F.abs(z))
    poly = t * (F.lit(0.319381530) + t * (F.lit(-0.356563782) + t * (F.lit(1.781477937) + t * (F.lit(-1.821255978) + t * F.lit(1.330274429)))))
    tail = F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, tail).otherwise(F.lit(1.0) - tail)


def randomness(runs: DataFrame) -> DataFrame:
    """Adds ``encoding``, ``length`` and the combined ``p`` to rows with ``value``;
    runs of no known encoding get null."""
    enc = alphabet = None
    for name, fits, letters in reversed(ENCODINGS):
        hit = F.col("value").rlike(fits)
        enc = F.when(hit, F.lit(name)) if enc is None else F.when(hit, F.lit(name)).otherwise(enc)
        alphabet = F.when(hit, F.lit(letters)) if alphabet is None else F.when(hit, F.lit(letters)).otherwise(alphabet)
    df = runs.withColumn("encoding", enc).withColumn("alphabet", alphabet)
    body = F.regexp_replace("value", "=+$", "")
    symbols = F.transform(F.filter(F.split(body, ""), lambda c: c != ""), lambda c: F.instr(F.col("alphabet"), c) - 1)
    df = df.withColumn("s", F.when(F.col("encoding").isNotNull(), symbols))
    df = df.withColumn("n", F.size("s").cast("double")).withColumn("a", F.char_length("alphabet").cast("double"))
    total = lambda arr: F.aggregate(arr, F.lit(0.0), lambda x, y: x + y)
    n, a = F.col("n"), F.col("a")
    df = df.withColumn("mean", total(F.transform("s", lambda x: x.cast("double"))) / n).withColumn("distinct", F.array_distinct("s"))
    df = df.withColumn("squares", total(F.transform("distinct", lambda d: F.pow(F.size(F.filter("s", lambda x: x == d)).cast("double"), F.lit(2.0)))))
    df = df.withColumn("high", total(F.transform("s", lambda x: F.when(x * 2 >= F.col("a"), 1.0).otherwise(0.0))))
    steps = F.sequence(F.lit(0), F.size("s") - 2)
    df = df.withColumn("turns", total(F.transform(steps, lambda i: F.when((F.get("s", i) * 2 >= F.col("a")) != (F.get("s", i + 1) * 2 >= F.col("a")), 1.0).otherwise(0.0))))
    df = df.withColumn("spread", total(F.transform("s", lambda x: (x - F.col("mean")) * (x - F.col("mean")))))
    df = df.withColumn("joint", total(F.transform(steps, lambda i: (F.get("s", i) - F.col("mean")) * (F.get("s", i + 1) - F.col("mean")))))

    chi = a / n * F.col("squares") - n
    p_chi = upper_tail((chi - (a - 1)) / F.sqrt(2 * (a - 1) * (n - 1) / n))
    prod = 2 * F.col("high") * (n - F.col("high"))
    p_runs = F.when(prod > n, 2 * upper_tail(F.abs(F.col("turns") + 1 - (prod / n + 1)) / F.sqrt(prod * (prod - n) / (n * n * (n - 1))))).otherwise(F.lit(0.0))
    p_serial = F.when(F.col("spread") > 0, 2 * upper_tail(F.abs(F.col("joint") / F.col("spread") + 1 / n) * F.sqrt(n))).otherwise(F.lit(0.0))
    logs = [F.log(F.greatest(F.least(p, F.lit(1.0)), F.lit(1e-300))) for p in (p_chi, p_runs, p_serial)]
    x = -(logs[0] + logs[1] + logs[2])           # half of Fisher's statistic, 6 degrees of freedom
    p = F.exp(-x) * (1 + x + x * x / 2)
    return df.withColumn("p", F.when(F.size("s") >= SHORTEST // 2, p)).withColumn("length", F.floor(F.log2(n) * 2)).drop(
        "alphabet", "s", "n", "a", "mean", "distinct", "squares", "high", "turns", "spread", "joint")


def thresholds(tested: DataFrame) -> DataFrame:
    """(encoding, length, least p) of each class: at most CELLS rows a class are
    gathered before the lowest admissible threshold is taken. A string counts
    once, however many copies it has: copies are not evenly spread draws."""
    cell = F.least(F.floor(F.col("p") * CELLS), F.lit(CELLS - 1)).cast("int")
    once = tested.filter("p is not null").select("encoding", "length", "p", F.xxhash64("value").alias("value")).distinct()
    cells = once.groupBy("encoding", "length", cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    up = Window.partitionBy("encoding", "length").orderBy(F.desc("cell"))
    kind = Window.partitionBy("encoding", "length")
    cells = cells.withColumn("found", F.sum("n").over(up)).withColumn(
        "random", F.sum(F.when(F.col("cell") >= CELLS // 2, F.col("n")).otherwise(0)).over(kind) * 2.0)
    wrong = F.col("found") - F.col("random") * (1 - F.col("cell") / CELLS)
    return cells.filter(wrong <= FALSE_SHARE * F.col("found")).groupBy("encoding", "length").agg((F.min("cell") / CELLS).alias("least_p"))


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row."""
    with Stages(docs.sparkSession) as stages:
        rows = base_spans(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text")))
        rows = with_spans(rows, "run", RUN, F.col("text").rlike(RUN), lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]"))
        taken = F.concat(*[F.col(k) for k in KINDS])
        rows = rows.withColumn("taken", taken).withColumn("run", F.filter("run", lambda r: ~overlaps(r["start"], r["end"], F.col("taken"))))
        rows = stages.write(rows.drop("text", "taken"), "base", keep=True)
        tested = stages.write(randomness(rows.select("row", F.explode("run").alias("r")).select("row", "r.*")), "tested")
        # a row per class of encoding and length
        passed = tested.join(F.broadcast(thresholds(tested)), ["encoding", "length"]).filter("p >= least_p")
        extra = stages.write(passed.groupBy("row").agg(F.collect_list(F.struct("start", "end", "value")).alias("random")), "random", keep=True)
    kind_spans = lambda k, i, col: F.transform(col, lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("kind"), F.concat_ws(":", F.lit(k), s["start"].cast("string"), s["end"].cast("string")).alias("label")))
    join = lambda spans: F.array_join(F.transform(F.array_sort(spans), lambda s: s["label"]), ",")
    out = rows.join(extra, "row", "left").withColumn("base", F.concat(*[kind_spans(k, i, F.col(k)) for i, k in enumerate(KINDS)]))
    added = kind_spans("random", len(KINDS), F.coalesce(F.col("random"), F.array().cast(SPAN)))
    return out.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(join(F.col("base")), 256).alias("base_sha256"),
                      join(F.concat(F.col("base"), added)).alias("spans"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    """The same rows in DuckDB SQL."""
    place = "CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT)"
    assign = ASSIGN.replace("'", "''")
    kinds = (("assign", assign, f"length(regexp_extract(value, '{assign}', 2)) >= 8"), ("access", ACCESS, "true"), ("hex", HEX, "true"),
             ("random", f"[A-Za-z0-9+/_=-]{{{SHORTEST},}}", "regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')"))
    spans = " UNION ALL ".join(
        f"SELECT row, '{k}' AS kind, {n} AS ko, value, st, st + length(value) AS en FROM (SELECT row, m[i] AS value, {place} AS st FROM ("
        f"SELECT row, m, g, unnest(range(1, len(m) + 1)) AS i FROM (SELECT row, regexp_extract_all(text, '{p}') AS m, regexp_split_to_array(text, '{p}') AS g FROM d))) WHERE {v}"
        for n, (k, p, v) in enumerate(kinds))
    enc = "CASE " + " ".join(f"WHEN regexp_matches(value, '{fits}') THEN '{name}'" for name, fits, _ in ENCODINGS) + " END"
    alphabet = "CASE " + " ".join(f"WHEN regexp_matches(value, '{fits}') THEN '{letters}'" for _, fits, letters in ENCODINGS) + " END"

    def tail(z: str) -> str:
        t = f"(1.0e0 / (1.0e0 + 0.2316419e0 * abs({z})))"
        poly = f"{t} * (0.319381530e0 + {t} * (-0.356563782e0 + {t} * (1.781477937e0 + {t} * (-1.821255978e0 + {t} * 1.330274429e0))))"
        up = f"exp(-({z}) * ({z}) / 2) / {math.sqrt(2 * math.pi)!r}e0 * {poly}"
        return f"(CASE WHEN {z} >= 0 THEN {up} ELSE 1.0e0 - {up} END)"

    log = lambda p: f"ln(greatest(least({p}, 1.0e0), 1e-300))"
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({spans}),
base AS (SELECT * FROM found WHERE kind <> 'random'),
run AS (SELECT * FROM found r WHERE kind = 'random' AND NOT EXISTS (SELECT 1 FROM base b WHERE b.row = r.row AND b.st < r.en AND r.st < b.en)),
a1 AS (SELECT row, st, en, value, {enc} AS encoding, {alphabet} AS letters, regexp_replace(value, '=+$', '') AS body FROM run),
a2 AS (SELECT *, CAST(length(letters) AS DOUBLE) AS a, CAST(length(body) AS DOUBLE) AS n,
              list_transform(range(1, length(body) + 1), lambda i: instr(letters, body[i]) - 1) AS s FROM a1 WHERE encoding IS NOT NULL),
a3 AS (SELECT *, list_sum(s) / n AS mean, list_sum(list_transform(list_distinct(s), lambda x: pow(len(list_filter(s, lambda y: y = x)), 2))) AS squares,
              CAST(len(list_filter(s, lambda x: x * 2 >= a)) AS DOUBLE) AS high,
              CAST(len(list_filter(range(1, len(s)), lambda i: (s[i] * 2 >= a) <> (s[i + 1] * 2 >= a))) AS DOUBLE) AS turns FROM a2),
a4 AS (SELECT *, list_sum(list_transform(s, lambda x: (x - mean) * (x - mean))) AS spread, 2 * high * (n - high) AS prod,
              list_sum(list_transform(range(1, len(s)), lambda i: (s[i] - mean) * (s[i + 1] - mean))) AS joint FROM a3),
a5 AS (SELECT *, (a / n * squares - n - (a - 1)) / sqrt(2 * (a - 1) * (n - 1) / n) AS z1,
              CASE WHEN prod > n THEN abs(turns + 1 - (prod / n + 1)) / sqrt(prod * (prod - n) / (n * n * (n - 1))) END AS z2,
              CASE WHEN spread > 0 THEN abs(joint / spread + 1 / n) * sqrt(n) END AS z3 FROM a4),
a6 AS (SELECT *, -({log(tail("z1"))} + {log(f"coalesce(2 * {tail('z2')}, 0.0e0)")} + {log(f"coalesce(2 * {tail('z3')}, 0.0e0)")}) AS x FROM a5),
tested AS (SELECT row, st, en, encoding, floor(log2(n) * 2) AS size, CASE WHEN len(s) >= {SHORTEST // 2} THEN exp(-x) * (1 + x + x * x / 2) END AS p FROM a6),
cells AS (SELECT encoding, size, CAST(least(floor(p * {CELLS}), {CELLS - 1}) AS INTEGER) AS cell, count(*) AS k FROM tested WHERE p IS NOT NULL GROUP BY ALL),
up AS (SELECT *, sum(k) OVER (PARTITION BY encoding, size ORDER BY cell DESC) AS seen,
              sum(CASE WHEN cell >= {CELLS // 2} THEN k ELSE 0 END) OVER (PARTITION BY encoding, size) * 2.0e0 AS rnd FROM cells),
least_p AS (SELECT encoding, size, min(cell) / {CELLS}.0e0 AS lp FROM up WHERE seen - rnd * (1 - cell / {CELLS}.0e0) <= {FALSE_SHARE}e0 * seen GROUP BY ALL),
every AS (SELECT row, st, ko, kind, en FROM base UNION ALL SELECT row, st, {len(KINDS)}, 'random', en FROM tested JOIN least_p USING (encoding, size) WHERE p >= lp),
listed AS (SELECT row, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in KINDS)},
                  string_agg(kind || ':' || st || ':' || en, ',' ORDER BY st, ko) FILTER (kind <> 'random') AS bs,
                  string_agg(kind || ':' || st || ':' || en, ',' ORDER BY st, ko) AS spans FROM every GROUP BY row)
SELECT doc_id, {", ".join(f"CAST(coalesce(n_{k}, 0) AS BIGINT) AS n_{k}" for k in KINDS)}, sha256(coalesce(bs, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN listed USING (row)"""


ORACLE = _oracle()
