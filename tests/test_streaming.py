"""Incremental enrichment: the streamed result equals the batch result."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlink.plans import bindings as B
from ledgerlink.plans import report
from ledgerlink.streaming.enrich import enrich_stream


def test_available_now_enrichment_matches_batch(spark):
    src = tempfile.mkdtemp(prefix="ll-stream-src-")
    lines = B.purchases(spark, SF_SMALL).select("l_orderkey", "l_linenumber", "ship_date", "currency",
                                               "amount", "cat_code")
    lines.repartition(3).write.mode("overwrite").parquet(src)          # three files arrive
    sink, ckpt = tempfile.mkdtemp(prefix="ll-stream-out-"), tempfile.mkdtemp(prefix="ll-stream-ckpt-")
    q = enrich_stream(spark, src, lines.schema, B.rates(spark), B.price_index(spark),
                      B.money_catalogue(spark, SF_SMALL), B.SPEC, "cat_code", "ship_date", "currency",
                      "amount", sink, ckpt, rates_rows=B.rates_max_rows(), max_files_per_trigger=1)
    q.awaitTermination(300)
    got = spark.read.parquet(sink)
    want = report.emissions_lines(lines, B.rates(spark), B.price_index(spark),
                                  B.money_catalogue(spark, SF_SMALL), B.SPEC, "cat_code", "ship_date",
                                  "currency", "amount", rates_rows=B.rates_max_rows())
    assert got.count() == want.count()
    a = got.agg(F.sum("co2e")).first()[0]
    b = want.agg(F.sum("co2e")).first()[0]
    assert abs(a - b) <= 1e-6 * abs(b)


def test_windowed_emissions_stream_totals(spark):
    from ledgerlink.streaming.enrich import monthly_emissions
    src = tempfile.mkdtemp(prefix="ll-win-src-")
    lines = report.emissions_lines(B.purchases(spark, SF_SMALL), B.rates(spark), B.price_index(spark),
                                   B.money_catalogue(spark, SF_SMALL), B.SPEC, "cat_code", "ship_date",
                                   "currency", "amount", rates_rows=B.rates_max_rows())
    lines = lines.select(F.col("ship_date").cast("timestamp").alias("ts"), "co2e")
    lines.repartition(2).write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(lines.schema).parquet(src)
    q = (monthly_emissions(stream, "ts").writeStream.outputMode("complete").format("memory")
         .queryName("ll_monthly").trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.sql("SELECT sum(co2e) AS s, sum(n_lines) AS n FROM ll_monthly").first()
    want = lines.agg(F.sum("co2e").alias("s"), F.count(F.lit(1)).alias("n")).first()
    assert got["n"] == want["n"] and abs(got["s"] - want["s"]) <= 1e-6 * abs(want["s"])
