"""Text -> vector, once per distinct text, with a row-level stage cache.

Embedders
---------
``char_profile``   character counts, pure column expression (checkable by SQL)
``tfidf_vectors``  ``pyspark.ml`` HashingTF + IDF + L2 Normalizer, distributed
``user function``  any ``pandas.Series[str] -> list[list[float]]`` callable run
                   in ``mapInPandas`` over Arrow batches (a local model, say)

The cache holds committed segments of vectors by model and version in a shared
folder (``stages.VectorCache``): only texts whose hash is missing are embedded.
The result never depends on what was cached before, and a run that is killed or
repeated leaves no row that counts twice.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.feature import HashingTF, IDF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.functions import text as TX
from ledgerlink.functions.cols import c
from ledgerlink.operators.stages import VectorCache
from ledgerlink.session import materialize, path_exists


def distinct_texts(df: DataFrame, text_col: str, normalise: bool = True) -> DataFrame:
    """Distinct (normalised) non-null texts of a column."""
    t = TX.normalize_text(c(text_col)) if normalise else c(text_col)
    return df.select(t.alias("text")).where(F.col("text").isNotNull()).distinct()


def char_profile_vectors(texts: DataFrame, text_col: str = "text") -> DataFrame:
    return texts.withColumn("embedding", TX.char_profile(c(text_col)))


def tfidf_vectors(texts: DataFrame, text_col: str = "text", num_features: int = 256) -> DataFrame:
    """HashingTF + IDF + L2 normaliser; dense ``array<double>`` output.
    ``IDF.fit`` is one distributed pass (document frequencies)."""
    tok = RegexTokenizer(inputCol=text_col, outputCol="_tok", pattern=r"[^\p{L}\p{Nd}]+", toLowercase=True)
    tf = HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features)
    # stored: the fit and the vectors both read the counts
    x = materialize(tf.transform(tok.transform(texts)).drop("_tok"), "term-counts")
    idf = IDF(inputCol="_tf", outputCol="_idf").fit(x)
    nrm = Normalizer(inputCol="_idf", outputCol="_n", p=2.0)
    y = nrm.transform(idf.transform(x))
    return y.select(*texts.columns, vector_to_array(F.col("_n")).alias("embedding"))


def user_vectors(texts: DataFrame, fn: Callable[[pd.Series], list], text_col: str = "text") -> DataFrame:
    """Run a user embedding function over Arrow batches of distinct texts."""
    schema = f"{text_col} string, embedding array<double>"

    def run(batches):
        for pdf in batches:
            vecs = fn(pdf[text_col])
            yield pd.DataFrame({text_col: pdf[text_col],
                                "embedding": [np.asarray(v, dtype=np.float64).tolist() for v in vecs]})

    return texts.select(text_col).mapInPandas(run, schema)


def cached_vectors(spark: SparkSession, cache_path: str, model: str, version: str = "") -> DataFrame | None:
    """(_h, text, embedding) of a cache; also of Parquet files that lie in its
    folder as such, with a column ``model``. None without any."""
    found = VectorCache(spark, cache_path, model, version).vectors()
    if not path_exists(spark, cache_path):
        return found
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache_path)
    files = [f.getPath() for f in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)]
    plain = [f.toString() for f in files if f.getName().endswith(".parquet")]
    if plain:
        # an append that ran twice leaves equal rows: one per text counts
        old = (spark.read.parquet(*plain).where(F.col("model") == model)
               .select(F.md5("text").alias("_h"), "text", "embedding").dropDuplicates(["_h"]))
        found = old if found is None else found.unionByName(old.join(found.select("_h"), "_h", "left_anti"))
    return found


def merge_with_cache(texts: DataFrame, cache_path: str | None, model: str,
                     embed: Callable[[DataFrame], DataFrame], version: str = "") -> tuple[DataFrame, DataFrame]:
    """(all vectors, newly computed vectors) for distinct ``texts``.

    Texts already in the cache for ``model`` and ``version`` are read back, by
    hash; only the rest are embedded. The caller commits the new rows with
    ``write_cache``; ``embed_cached`` does both.
    """
    cached = cached_vectors(texts.sparkSession, cache_path, model, version) if cache_path else None
    if cached is None:
        new = embed(texts)
        return new.withColumn("from_cache", F.lit(False)), new
    keyed = texts.withColumn("_h", F.md5("text"))
    new = embed(keyed.join(cached.select("_h"), "_h", "left_anti").drop("_h"))
    hit = cached.join(keyed.select("_h"), "_h", "left_semi").drop("_h").withColumn("from_cache", F.lit(True))
    return hit.unionByName(new.withColumn("from_cache", F.lit(False))), new


def write_cache(new: DataFrame, cache_path: str, model: str, version: str = "") -> bool:
    """Commit new vectors as one segment of the cache; False if a segment of the
    same texts is there already."""
    return VectorCache(new.sparkSession, cache_path, model, version).add(new.select("text", "embedding"))


def embed_cached(texts: DataFrame, cache_path: str, model: str, embed: Callable[[DataFrame], DataFrame],
                 version: str = "", parts: int = 1) -> DataFrame:
    """(text, embedding) of distinct ``texts`` from the cache, after what it
    lacks is embedded and committed in ``parts`` segments."""
    cache = VectorCache(texts.sparkSession, cache_path, model, version)
    cache.ensure(texts, embed, parts)
    have = cache.vectors()
    if have is None:
        return embed(texts.limit(0)).select("text", "embedding")
    return have.join(texts.select(F.md5("text").alias("_h")).distinct(), "_h", "left_semi").select("text", "embedding")


def embed_distinct(df: DataFrame, text_col: str, embed: Callable[[DataFrame], DataFrame],
                   normalise: bool = True) -> DataFrame:
    """M1: embed each distinct (normalised) text once, join the vectors back to
    every row (left join: rows with a null text keep a null vector).

    Texts are normalised in one pass, which stores them with their 128-bit hash
    and a row number. The first row of each hash is found from these two alone,
    its text is fetched by the row number, and rows and vectors meet on the
    hash: no text is sorted, compared or a join key."""
    text = TX.normalize_text(c(text_col)) if normalise else c(text_col)
    rows = materialize(df.withColumn("_t", text).withColumn("_h", F.md5("_t")).withColumn("_row", F.monotonically_increasing_id()), "texts")
    first = rows.where(F.col("_h").isNotNull()).groupBy("_h").agg(F.min("_row").alias("_row"))
    uniq = materialize(rows.select("_row", F.col("_t").alias("text")).join(first.select("_row"), "_row", "left_semi").select("text"), "distinct-texts")
    vecs = materialize(embed(uniq).select(F.md5("text").alias("_h"), "embedding"), "vectors")
    return rows.drop("_t", "_row").join(vecs, "_h", "left").drop("_h")
