"""Helpers shared by the corpus operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.session import bounded_broadcast, delete_path, materialize, scratch_path  # noqa: F401  (re-exported)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker process, so a
    reused worker keeps e.g. a loaded tokenizer between tasks."""
    name = "_ledgerlink_worker_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__.setdefault("items", {})


def keep_for_task(key: object) -> None:
    """Say that the running task uses an entry of the worker's cache."""
    worker_cache().setdefault("used", set()).add(key)


def drop_unused() -> None:
    """Drop what the worker's last task did not use, such as the tokenizer of an
    operator that has ended."""
    cache = worker_cache()
    used = cache.pop("used", set())
    for key in [k for k in cache if k not in used]:
        del cache[key]


def give_back() -> None:
    """Return freed memory of this Python worker to the system: an idle worker
    waits for its next task beside the JVM's."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):            # another C library
        pass


def frugal(run):
    """A function over batches that gives memory back when its task ends."""
    def wrapped(batches):
        try:
            worker_cache().pop("used", None)
            yield from run(batches)
        finally:
            drop_unused()
            give_back()
    return wrapped


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once under the shared checkpoint folder and read back."""
    return materialize(df, name)


class Stages:
    """Stored intermediate tables of one operator; those not kept are deleted
    when the operator has what it needs."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *_: object) -> None:
        for path in self.paths:
            delete_path(self.spark, path)

    def write(self, df: DataFrame, name: str, keep: bool = False) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        if not keep:
            self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)


def broadcast_below(df: DataFrame, row_bytes: Column, max_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if its rows, measured by ``row_bytes``, take at
    most ``max_bytes``; the same rows come out of either join."""
    size = df.agg(F.sum(row_bytes.cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Where the text is all ASCII the built-in ``lower``
    does it; other texts go through ``translate``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower()))


def doc_hash_mod(doc_id: Column, m: int) -> Column:
    """crc32(doc_id as text) mod m; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % m


def pieces(texts: list, most_chars: int = 8_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``most_chars`` characters."""
    at = 0
    while at < len(texts):
        stop, chars = at, 0
        while stop < len(texts) and (stop == at or chars + len(texts[stop] or "") <= most_chars):
            chars += len(texts[stop] or "")
            stop += 1
        yield at, stop
        at = stop


def runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """(key, rows) of consecutive rows with equal keys, across batches."""
    key, held = None, []
    for pdf in batches:
        for new, rows in pdf.groupby(keys, sort=False, dropna=False):
            if new != key:
                if held:
                    yield key, pd.concat(held, ignore_index=True) if len(held) > 1 else held[0].reset_index(drop=True)
                key, held = new, []
            held.append(rows)
    if held:
        yield key, pd.concat(held, ignore_index=True) if len(held) > 1 else held[0].reset_index(drop=True)
