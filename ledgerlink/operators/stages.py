"""Stages that are computed once (S6): manifests keyed by what a stage depends on.

A stage's key is made of an order-free fingerprint of each input's rows, the
version of the code and its parameters (e.g. the model's name). Its rows are
written to a folder of their own, which nobody reads until a manifest names it.
The manifest is written beside the data and renamed to its key: a rename that
does not replace is the commit, so a run that is killed leaves a folder without
a manifest, and of two runs that commit the same key the first one counts.
Everything goes through Hadoop's file system, in a folder that all share.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.functions.cols import c
from ledgerlink.session import delete_path


def row_hash(columns: list[str], salt: int = 0) -> Column:
    """64-bit hash of a row; nulls count by their place."""
    nulls = F.concat(*[F.when(c(x).isNull(), F.lit("1")).otherwise(F.lit("0")) for x in columns]) if columns else F.lit("")
    return F.xxhash64(F.lit(salt), *[c(x) for x in columns], nulls)


def fingerprint(df: DataFrame) -> str:
    """Fingerprint of a table's rows, whatever their order and partitions: names and
    types of the columns, number of rows, and two sums of row hashes (so rows
    that occur twice count twice). One pass with partial sums."""
    sums = [F.sum(row_hash(df.columns, salt).cast("decimal(38,0)")).alias(f"s{salt}") for salt in (1, 2)]
    r = df.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    text = json.dumps([[f.name, f.dataType.simpleString()] for f in df.schema.fields]) + f"|{r['n']}|{r['s1'] or 0}|{r['s2'] or 0}"
    return hashlib.sha256(text.encode()).hexdigest()


class StageStore:
    """Committed stages under one shared folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    # ------------------------------------------------------------- files

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _write(self, path: str, text: str) -> None:
        out = self._fs().create(self._path(path), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def _read(self, path: str) -> str:
        io = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils
        source = self._fs().open(self._path(path))
        try:
            return io.toString(source, "UTF-8")
        finally:
            source.close()

    def _rename_new(self, old: str, new: str) -> bool:
        """Rename a file unless the new name is taken."""
        jvm = self.spark.sparkContext._jvm
        fs = jvm.org.apache.hadoop.fs
        target = self._path(new)
        context = fs.FileContext.getFileContext(self._fs().getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(context.makeQualified(self._path(old)), context.makeQualified(target), options)
            return True
        except Exception as e:
            if "FileAlreadyExists" in str(e) or self._fs().exists(target):
                return False
            raise

    # --------------------------------------------------------- manifests

    def manifests(self, name: str) -> dict[str, dict]:
        """Committed stages of a name, by key."""
        at = self._path(f"{self.folder}/{name}")
        fs = self._fs()
        if not fs.exists(at):
            return {}
        files = sorted(s.getPath().getName() for s in fs.listStatus(at))
        return {f[:-5]: json.loads(self._read(f"{self.folder}/{name}/{f}")) for f in files if f.endswith(".json") and not f.startswith("_")}

    def find(self, name: str, key: str) -> dict | None:
        path = f"{self.folder}/{name}/{key}.json"
        return json.loads(self._read(path)) if self._fs().exists(self._path(path)) else None

    def load(self, manifest: dict) -> DataFrame:
        return self.spark.read.schema(manifest["schema"]).parquet(f"{self.folder}/{manifest['data']}")

    def commit(self, name: str, key: str | Callable[[DataFrame], str], df: DataFrame, **facts) -> tuple[dict, bool]:
        """(manifest of the committed stage, whether this call committed it). The key
        may be made from the rows as they were written."""
        run = uuid.uuid4().hex
        data = f"{name}/_data-{run}"
        df.write.parquet(f"{self.folder}/{data}")
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        manifest = {"data": data, "schema": schema, **facts}
        if callable(key):
            key = key(self.load(manifest))
        manifest["key"] = key
        self._write(f"{self.folder}/{name}/_manifest-{run}", json.dumps(manifest))
        if self._rename_new(f"{self.folder}/{name}/_manifest-{run}", f"{self.folder}/{name}/{key}.json"):
            return manifest, True
        delete_path(self.spark, f"{self.folder}/{name}/_manifest-{run}")
        delete_path(self.spark, f"{self.folder}/{data}")
        return self.find(name, key), False

    # -------------------------------------------------------------- use

    def key(self, inputs: list[DataFrame], version: str, params: dict | None = None) -> str:
        parts = [[fingerprint(x) for x in inputs], version, json.dumps(params or {}, sort_keys=True)]
        return hashlib.sha256(json.dumps(parts).encode()).hexdigest()[:40]

    def reuse(self, name: str, inputs: list[DataFrame], compute: Callable[..., DataFrame], version: str, params: dict | None = None) -> DataFrame:
        """``compute(*inputs)`` as a stored table; read back where a stage of the same
        inputs, version and parameters is committed."""
        key = self.key(inputs, version, params)
        found = self.find(name, key)
        if found is None:
            found, _ = self.commit(name, key, compute(*inputs), version=version, params=params or {})
        return self.load(found)

    def sweep(self, name: str) -> int:
        """Delete what killed runs left: data and manifests that no committed
        manifest names. Call it while no run is writing. Returns how many."""
        fs, at = self._fs(), f"{self.folder}/{name}"
        if not fs.exists(self._path(at)):
            return 0
        named = {m["data"].split("/")[-1] for m in self.manifests(name).values()}
        left = [s.getPath().getName() for s in fs.listStatus(self._path(at))]
        left = [x for x in left if x.startswith(("_data-", "_manifest-")) and x not in named]
        for x in left:
            delete_path(self.spark, f"{at}/{x}")
        return len(left)


class VectorCache:
    """Vectors of texts by model and version: committed segments of (hash of the
    text, text, embedding). Texts are looked up by 128-bit hash, and only those
    that no segment holds are embedded."""

    def __init__(self, spark: SparkSession, folder: str, model: str, version: str = ""):
        self.store = StageStore(spark, folder)
        self.model, self.version = model, version
        self.name = "model-" + hashlib.sha256(f"{model}\x00{version}".encode()).hexdigest()[:16]

    def vectors(self) -> DataFrame | None:
        """All committed rows, one per text; None without any."""
        found = list(self.store.manifests(self.name).values())
        if not found:
            return None
        out = self.store.spark.read.schema(found[0]["schema"]).parquet(*[f"{self.store.folder}/{m['data']}" for m in found])
        # two runs at a time may each have committed a text
        return out.dropDuplicates(["_h"]) if len(found) > 1 else out

    def add(self, new: DataFrame) -> bool:
        """Commit vectors (text, embedding) as one segment, named by the texts in it;
        False if that segment is there already."""
        rows = new.select(F.md5("text").alias("_h"), "text", "embedding")
        return self.store.commit(self.name, lambda written: "seg-" + fingerprint(written.select("_h"))[:40], rows, model=self.model, version=self.version)[1]

    def missing(self, texts: DataFrame) -> DataFrame:
        """(_h, text) of the distinct texts that no segment holds."""
        known = self.vectors()
        want = texts.select(F.md5("text").alias("_h"), "text").where(F.col("text").isNotNull())
        want = want if known is None else want.join(known.select("_h"), "_h", "left_anti")
        return want.dropDuplicates(["_h"])

    def ensure(self, texts: DataFrame, embed: Callable[[DataFrame], DataFrame], parts: int = 1) -> int:
        """Embed and commit what is missing, in ``parts`` segments by hash, so that a
        run that is killed keeps the segments it has committed. Returns how many
        were committed."""
        from ledgerlink.session import materialize
        todo = materialize(self.missing(texts), "texts-to-embed")
        done = 0
        for part in range(parts):
            some = todo if parts == 1 else todo.where(F.pmod(F.xxhash64("_h"), F.lit(parts)) == part)
            if not some.isEmpty():
                done += self.add(embed(some.select("text")))
        return done
