"""What is embedded, and how often."""

import pathlib
import uuid

from pyspark.sql import functions as F

from ledgerlink.operators import matching as MT


def test_each_distinct_text_is_embedded_once(spark, tmp_path):
    folder = str(tmp_path)

    def embed(text):
        pathlib.Path(folder, uuid.uuid4().hex).write_text(text)
        return [float(len(text)), 1.0]

    spark.createDataFrame([(i, ["red pen", "blue ink", None][i % 3]) for i in range(60)], "id long, t string").write.parquet(f"{folder}-rows")
    rows = spark.read.parquet(f"{folder}-rows")
    cat = spark.createDataFrame([("A", "pen"), ("B", "a long bottle of ink")], "code string, what string")
    out = MT.match_pipeline(rows, "t", cat, "code", "what", F.udf(embed, "array<double>"), 2, 0.8, 0.2).collect()
    assert len(out) == 60 and {r.t for r in out if r.match_id is None} == {None}
    # two texts and two options, each at most a second time for a stage that Spark plans twice
    assert len(list(pathlib.Path(folder).iterdir())) <= 8
