"""Session construction and the few session-level helpers every job needs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Defaults tuned for correctness parity with the DuckDB oracle (UTC, ANSI)
# and for runtime re-planning (AQE) on a real cluster.
_DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # runtime (post-shuffle, measured) broadcast threshold used by AQE
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "ledgerlink", extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the library defaults.

    On a cluster, leave ``master`` unset and size ``shuffle_partitions`` to the
    data (roughly input bytes / 128 MB); locally ``local[N]`` with N partitions.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, allow_local_default: bool = False) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Stages, caches and lineage cuts are written there. A cluster names a shared
    folder; only tests (``allow_local_default=True``) may fall back to a fresh
    local temporary folder when the setting is absent.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not allow_local_default:
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder")
        d = tempfile.mkdtemp(prefix="ledgerlink-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder for ``DataFrame.checkpoint``: the session's
    ``spark.checkpoint.dir``; a local temporary folder only in local mode."""
    return checkpoint_dir(spark, allow_local_default=spark.sparkContext.master.startswith("local"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder name of the shared checkpoint folder.
    Spark's writers create it, on whatever file system the folder names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, through Hadoop's file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def session_key(spark: SparkSession) -> tuple:
    """Identity of a live session (application id + JVM session object)."""
    return (spark.sparkContext.applicationId, id(spark._jsparkSession))


MAX_BROADCAST_BYTES = 256 << 20


def row_bytes(df: DataFrame) -> Column:
    """Measured size of a row: text and binary by their bytes, arrays and maps by
    8 bytes an entry (text entries by their bytes), other columns 8 bytes."""
    out = F.lit(16).cast("long")
    for f in df.schema.fields:
        x = F.col("`" + f.name.replace("`", "``") + "`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = F.octet_length(x)
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, (T.StringType, T.BinaryType)):
            size = F.aggregate(x, F.lit(0), lambda s, y: s + F.coalesce(F.octet_length(y), F.lit(0)) + 8)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType)):
            size = F.size(x) * 8
        else:
            size = F.lit(8)
        out = out + F.greatest(F.coalesce(size, F.lit(0)), F.lit(0))
    return out


def bounded_size(df: DataFrame, max_rows: int) -> tuple[int, int]:
    """(rows, bytes) of at most ``max_rows + 1`` rows: a bounded action, taken
    anew each time, since a table may have grown since the last look."""
    r = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(row_bytes(df))).first()
    return r[0], r[1] or 0


def bounded_rows(df: DataFrame, max_rows: int) -> int:
    """min(row count, max_rows + 1)."""
    return df.limit(max_rows + 1).count()


def bounded_broadcast(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only if it measurably holds at most ``max_rows`` rows and
    ``max_bytes`` bytes.

    Beyond the bounds the plain DataFrame is returned and Spark plans a shuffle
    join (AQE may still convert it at runtime from measured sizes).
    """
    rows, size = bounded_size(df, max_rows)
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or a folder with something in it exists, through Hadoop's
    file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and len(fs.listStatus(p)) > 0


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read
    it back: a lineage cut that survives executor loss (one job, unlike an
    eager reliable ``checkpoint``, which computes its input twice)."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    _STAGES.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    return df.sparkSession.read.parquet(path)


_STAGES: dict[str, list[str]] = {}


def release_stages(spark: SparkSession) -> int:
    """Delete the stages that this application has materialised; call it when the
    results that read them are written. Returns how many there were."""
    paths = _STAGES.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        delete_path(spark, path)
    return len(paths)
