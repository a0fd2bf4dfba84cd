"""Table operators: dedupe, counts, shares, batching, corrections, unions.

Ordering-dependent operators (fixed batches, token-budget batches, dense row
ids, exact medians) are built on ``global_order_index``: range-partition on the
order key, number rows inside each partition, then add the row count (and
value sum) of all earlier partitions (all JVM-side). That gives the exact global position and
running sum without the single-partition exchange a global window needs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlink.functions.cols import c, existing, numeric_fields, string_fields
from ledgerlink.session import bounded_broadcast, materialize


# ----------------------------------------------------------------- dedupe / counts

def distinct_rows(df: DataFrame) -> DataFrame:
    """A1: full-row distinct."""
    return df.dropDuplicates()


def distinct_keep_first(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """A2: one row per key, the one with the lowest ``order_col``.

    A grouped ``min`` over a struct led by the order column: deterministic, and
    combined map-side, so a key holding a third of all rows costs one row per
    map task in the shuffle, not a third of the table in one task.
    """
    others = [x for x in df.columns if x not in keys and x != order_col]
    agg = df.groupBy(*[c(k) for k in keys]).agg(
        F.min(F.struct(c(order_col), *[c(o) for o in others])).alias("_first"))
    return agg.select(*[c(k) for k in keys], *[F.col("_first")[x].alias(x) for x in [order_col] + others])


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """A4: counts per value, nulls dropped, most frequent first."""
    return (df.where(c(col).isNotNull()).groupBy(c(col)).agg(F.count(F.lit(1)).alias(name))
            .orderBy(F.desc(name), c(col)))


def value_share(counts: DataFrame, count_col: str = "count", name: str = "share") -> DataFrame:
    """Count / total; the total is a scalar subquery over the
    aggregated counts (partial sums, no single-partition window)."""
    total = counts.select(F.sum(count_col)).scalar()
    return counts.withColumn(name, F.col(count_col) / total)


def dropna_all(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows where every listed column is null."""
    return df.na.drop(how="all", subset=cols)


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop columns, ignoring names that are absent."""
    return df.drop(*existing(df, names))


def prefix_columns(df: DataFrame, prefix: str, keep: list[str] | None = None) -> DataFrame:
    """P5/Q14: prefix every column except ``keep`` (e.g. ``target.`` on the
    catalogue side), so a source and a catalogue column of one name never
    collide after a join."""
    keep = set(keep or [])
    return df.withColumnsRenamed({x: f"{prefix}{x}" for x in df.columns if x not in keep})


def register_result_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a result table to SQL / BI tools as a temporary view."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def union_missing_columns(dfs: list[DataFrame]) -> DataFrame:
    """Concatenate tables with different columns; missing ones are null."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def sample_n(df: DataFrame, n: int, key_cols: list[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows, repeatable: the n smallest seeded MD5 hashes.
    Planned as a distributed top-k (``TakeOrderedAndProject``), not a sort."""
    h = F.md5(F.concat_ws("|", *[c(k).cast("string") for k in key_cols], F.lit(str(seed))))
    return df.withColumn("_h", h).orderBy("_h", *key_cols).limit(n).drop("_h")


def head_n(df: DataFrame, order_cols: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows by a key order (a top-k, not a full sort)."""
    return df.orderBy(*[c(o) for o in order_cols]).limit(n)


def default_measures(df: DataFrame) -> DataFrame:
    """One pass; numeric columns summed, text columns counted."""
    nums = set(numeric_fields(df))
    strs = set(string_fields(df))
    aggs = []
    for f in df.columns:
        if f in nums:
            aggs.append(F.sum(c(f)).alias(f"sum_{f}"))
        elif f in strs:
            aggs.append(F.count(c(f)).alias(f"cnt_{f}"))
    return df.agg(*aggs)


# ------------------------------------------------------------ global order / batches

def global_order_index(df: DataFrame, order_cols: list[str], value_col: str | None = None,
                       num_partitions: int | None = None) -> DataFrame:
    """Add ``_gidx`` (0-based position in ``order_cols`` order) and, with
    ``value_col``, ``_gcum`` (inclusive running sum of it).

    1. range-partition and sort on the order key (sampled bounds, no single
       partition); ``monotonically_increasing_id`` then holds (partition id,
       position inside the partition);
    2. the narrow numbered rows are written once to the shared checkpoint
       folder (lineage cut; a lost executor cannot re-sample other bounds);
    3. per-partition counts and sums (one row per partition, collected) give
       each partition's offset, applied as an access to a literal array.
    Pass a narrow DataFrame (keys and values); order columns must identify rows.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = [c(o) for o in order_cols]
    mid = F.monotonically_increasing_id()
    local = (df.repartitionByRange(n, *ordered).sortWithinPartitions(*ordered)
             .withColumn("_mid", mid)
             .withColumn("_pid", F.shiftright(F.col("_mid"), 33))
             .withColumn("_lidx", F.col("_mid") - F.shiftleft(F.col("_pid"), 33))
             .drop("_mid"))
    local = materialize(local, "order-index")
    if value_col is not None:
        wl = Window.partitionBy("_pid").orderBy("_lidx").rowsBetween(Window.unboundedPreceding, 0)
        local = local.withColumn("_lcum", F.sum(c(value_col).cast("double")).over(wl))
    # one row per partition (bounded by the partition count), read from the
    # written stage; offsets are prefix sums over partition ids, injected as a
    # literal array: no single-partition exchange anywhere in the plan
    stats = (local.groupBy("_pid")
             .agg(F.count(F.lit(1)).alias("_pn"),
                  (F.sum(c(value_col)).cast("double") if value_col else F.lit(0.0)).alias("_ps"))
             .collect())
    off, soff, run_n, run_s = {}, {}, 0, 0.0
    for r in sorted(stats, key=lambda r: r["_pid"]):
        off[r["_pid"]], soff[r["_pid"]] = run_n, run_s
        run_n += r["_pn"]
        run_s += float(r["_ps"] or 0.0)

    def lookup(d, typ):
        # an array indexed by partition: one access a row, however many partitions
        values = ",".join(f"CAST({d.get(i, 0)!r} AS {typ})" for i in range(max(d, default=0) + 1))
        return F.get(F.expr(f"array({values})"), F.col("_pid").cast("int"))
    out = local.withColumn("_off", lookup(off, "long")).withColumn("_soff", lookup(soff, "double"))
    out = out.withColumn("_gidx", F.col("_off") + F.col("_lidx"))
    if value_col is not None:
        out = out.withColumn("_gcum", F.col("_soff") + F.col("_lcum")).drop("_lcum")
    return out.drop("_pid", "_lidx", "_off", "_soff")


def fixed_batches(df: DataFrame, order_cols: list[str], batch_rows: int) -> DataFrame:
    """Consecutive batches of ``batch_rows`` rows in key order."""
    g = global_order_index(df, order_cols)
    return g.withColumn("batch_id", F.floor(F.col("_gidx") / F.lit(batch_rows)).cast("long")) \
            .withColumnRenamed("_gidx", "row_index")


def ordered_stage(df: DataFrame, order_cols: list[str], num_partitions: int | None = None) -> DataFrame:
    """The rows range-partitioned and sorted on the order key, as a stored table
    with ``_pid`` (range partition) and ``_lidx`` (position inside it)."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = [c(o) for o in order_cols]
    mid = F.monotonically_increasing_id()
    local = df.repartitionByRange(n, *ordered).sortWithinPartitions(*ordered).withColumn("_mid", mid)
    return materialize(local.withColumn("_pid", F.shiftright("_mid", 33)).withColumn(
        "_lidx", F.col("_mid") - F.shiftleft("_pid", 33)).drop("_mid"), "ordered")


def running_total(ordered: DataFrame, value: Column, name: str) -> DataFrame:
    """Inclusive running sum of a whole-number ``value`` over an ``ordered_stage``:
    a window inside each range partition, and one offset per partition (as many
    rows as partitions reach the driver)."""
    totals = ordered.groupBy("_pid").agg(F.sum(value).cast("long").alias("s")).collect()
    before, offsets = 0, {}
    for r in sorted(totals, key=lambda r: r["_pid"]):
        offsets[r["_pid"]] = before
        before += r["s"] or 0
    literal = F.expr("array(" + ",".join(f"{offsets.get(i, 0)}L" for i in range(max(offsets, default=0) + 1)) + ")")
    inside = F.sum(value).over(Window.partitionBy("_pid").orderBy("_lidx").rowsBetween(Window.unboundedPreceding, 0))
    return ordered.withColumn(name, (F.get(literal, F.col("_pid").cast("int")) + inside).cast("long"))


#: Token budgets that one task packs at a time.
PACK_BUDGETS = 16


def _pack_block(pos: np.ndarray, size: np.ndarray, first: float, width: float, budget: int) -> pd.DataFrame:
    """Batches begun in one block of positions ``first <= pos < first + width``.

    ``pos`` and ``size`` (ascending, rows of at least one token) also hold the
    rows up to a budget behind the block. A batch that begins at row i ends
    before the first row whose end is beyond ``pos[i] + budget``. Batches from
    earlier blocks can lead only to rows less than a budget behind the block's
    border, or to its first row. For each of those: the position where the
    first batch behind the block begins, and the starts on the way there."""
    ends = pos + size
    following = np.maximum(np.searchsorted(ends, pos + budget, side="right"), np.arange(len(pos)) + 1)
    starts = np.append(pos, ends[-1])                   # behind the last row known the next one begins
    inside = int(np.searchsorted(pos, first + width))
    entries = np.flatnonzero((pos[:inside] < first + budget) | (np.arange(inside) == 0))
    at, chain = entries.copy(), [[int(pos[e])] for e in entries]
    open_ = np.arange(len(entries))
    while len(open_):
        at[open_] = following[at[open_]]
        open_ = open_[at[open_] < inside]
        for i in open_:
            chain[i].append(int(pos[at[i]]))
    return pd.DataFrame({"pos": pos[entries], "to": starts[at], "starts": chain})


def batch_starts(rows: DataFrame, budget: int, pack_budgets: int = PACK_BUDGETS) -> DataFrame:
    """Positions (``pos``: tokens before) of the rows that begin a batch, of rows
    ``(pos, size)`` with sizes of at least 1 that follow on each other from 0.

    Where the next batch begins is a range lookup, made in blocks of
    ``pack_budgets`` budgets of tokens, each with the rows of one more budget.
    A block reduces the rows that a batch can begin with near its border to
    pointers over the block. Which pointers are really taken is found by pointer
    doubling: pointers are joined with themselves until one leads from the first
    row over all blocks, each time only those that others lead to; from the
    longest back to the shortest, they mark the rows reached. That takes
    log2(blocks) joins of ever fewer rows."""
    width = pack_budgets * budget
    block = F.floor(F.col("pos") / F.lit(width)).cast("long")
    near = (F.col("pos") % width < budget) & (block > 0)
    placed = rows.select("pos", "size", F.explode(F.when(near, F.array(block, block - 1)).otherwise(F.array(block))).alias("block"))

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        pos, first = pdf["pos"].to_numpy(), key[0] * width
        if pos[0] >= first + width:                     # a block that one long row spans: only rows behind it
            return pd.DataFrame({"pos": pos[:0], "to": pos[:0], "starts": pd.Series([], dtype=object)})
        return _pack_block(pos, pdf["size"].to_numpy(), first, width, budget)

    pointers = materialize(placed.groupBy("block").applyInPandas(pack, "pos long, to long, starts array<long>"), "batch-pointers")
    # some block has at least one pointer, so this many doublings reach the end
    last = pointers.agg(F.max("to")).first()[0] or 0
    levels = [pointers.select("pos", "to")]
    while width << (len(levels) - 1) < last:
        step = levels[-1]
        reached = step.select(F.col("to").alias("pos")).distinct().unionByName(step.filter("pos = 0").select("pos")).distinct()
        twice = step.join(reached, "pos", "left_semi").join(step.select(F.col("pos").alias("to"), F.col("to").alias("_to")), "to", "left")
        levels.append(materialize(twice.select("pos", F.coalesce("_to", "to").alias("to")), "batch-pointers"))
    marked = pointers.filter("pos = 0").select("pos")
    for step in reversed(levels[1:]):
        marked = materialize(marked.unionByName(step.join(marked, "pos").select(F.col("to").alias("pos"))).distinct(), "batch-marks")
    one = levels[0].join(marked, "pos").select(F.col("to").alias("pos"))
    taken = marked.unionByName(one).distinct()
    return pointers.join(taken, "pos").select(F.explode("starts").alias("pos")).distinct()


def token_budget_batches(df: DataFrame, order_cols: list[str], token_col: str,
                         budget: int, pack_budgets: int = PACK_BUDGETS) -> DataFrame:
    """Consecutive batches in key order, each as long as its tokens stay within
    ``budget``; a row above the budget is a batch by itself.

    Adds ``tokens_before`` and ``batch_id`` (0, 1, ...). Null and negative counts
    are zero; rows without tokens belong to the batch of the row before. No
    partition holds more than a range of the rows: starts of batches come from
    ``batch_starts``, and their running count numbers the batches."""
    if budget < 1:
        raise ValueError("the budget must be at least 1")
    size = F.greatest(F.coalesce(c(token_col).cast("long"), F.lit(0)), F.lit(0))
    ordered = ordered_stage(df.withColumn("_size", size), order_cols)
    placed = running_total(ordered, F.col("_size"), "_end").withColumn("tokens_before", F.col("_end") - F.col("_size"))
    placed = materialize(placed.drop("_end"), "token-positions")
    rows = placed.filter("_size > 0").select(F.col("tokens_before").alias("pos"), F.col("_size").alias("size"))
    starts = materialize(batch_starts(rows, budget, pack_budgets), "batch-starts")
    # rows with tokens have positions of their own; a start is one of them
    flag = F.when(F.col("_size") > 0, F.col("tokens_before"))
    starts = starts.select(F.col("pos").alias("_at"), F.lit(1).alias("_start"))
    marked = materialize(placed.withColumn("_at", flag).join(bounded_broadcast(starts, 1_000_000), "_at", "left").drop("_at"), "batch-starts")
    out = running_total(marked, F.coalesce("_start", F.lit(0)), "_n")
    return out.withColumn("batch_id", F.greatest(F.col("_n") - 1, F.lit(0)).cast("long")).drop("_n", "_start", "_size", "_pid", "_lidx")


def dense_row_id(df: DataFrame, order_cols: list[str], name: str = "row_id") -> DataFrame:
    """Ids 0..n-1 in key order (the reference's index reset), stable
    across re-runs, unlike ``monotonically_increasing_id``."""
    return global_order_index(df, order_cols).withColumnRenamed("_gidx", name)


def content_key(cols: list, name: str = "sk") -> Column:
    """Stable content key: all 128 bits of the MD5 of the columns, in hex."""
    return F.md5(F.concat_ws("\u0001", *[F.coalesce(c(x).cast("string"), F.lit("\u0002"))
                                         for x in cols])).alias(name)


def exact_median_by(df: DataFrame, keys, value: str, name: str = "median") -> DataFrame:
    """Exact median per key (mean of the middle two), nulls ignored.

    Rows are globally ordered by (keys, value); each key's middle positions are
    computed from its first position and count, and the middle rows are picked
    by an equi join on the global position, which is unique per row, so a key
    holding a third of all rows is never gathered into one task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    ks = [f"_k{i}" for i in range(len(keys))]
    base = df.select(*[c(k).alias(a) for k, a in zip(keys, ks)], c(value).cast("double").alias("_v")).where(
        F.col("_v").isNotNull())
    # the last sort column differs in every row, so equal values split between partitions
    g = global_order_index(base.withColumn("_u", F.monotonically_increasing_id()), ks + ["_v", "_u"])
    stats = g.groupBy(*ks).agg(F.min("_gidx").alias("_start"), F.count(F.lit(1)).alias("_n"))
    targets = stats.select(
        *ks, F.explode(F.array((F.col("_start") + F.floor((F.col("_n") - 1) / 2)).cast("long"),
                               (F.col("_start") + F.floor(F.col("_n") / 2)).cast("long"))).alias("_gidx")
    ).dropDuplicates(["_gidx"])
    mids = g.join(targets.drop(*ks), "_gidx")
    out = mids.groupBy(*ks).agg(F.avg("_v").alias(name))
    return out.select(*[F.col(a).alias(k) for k, a in zip(keys, ks)], name)


# ------------------------------------------------------------------ corrections

def apply_corrections(src: DataFrame, corrections: DataFrame, key: str,
                      broadcast_max_rows: int = 1_000_000) -> DataFrame:
    """Left join on ``key``; every column the correction table shares
    with the source is replaced where the correction is non-null.

    Corrections are made unique by key first (in each column the lowest correction
    that is not null), unknown columns are ignored, and null keys never match.
    """
    shared = [x for x in corrections.columns if x != key and x in src.columns]
    corr = corrections.select(c(key), *[c(x) for x in shared]).where(c(key).isNotNull())
    if not shared:
        return src
    corr = corr.groupBy(c(key)).agg(*[F.min(c(x)).alias(f"{x}__corr") for x in shared])
    corr = bounded_broadcast(corr, broadcast_max_rows)
    joined = src.join(corr, on=key, how="left")
    return joined.select(*[
        (F.coalesce(c(f"{x}__corr"), c(x)).alias(x) if x in shared else c(x)) for x in src.columns])
