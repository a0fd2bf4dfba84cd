"""Physical-plan checks: the plan shapes the design relies on."""

from conftest import SF_SMALL, plan_text


def _plan(spark, qs, key):
    df = qs[key](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()      # final adaptive plan
    return plan_text(df)


def test_no_nested_loop_or_cartesian_anywhere(spark, qs):
    for key in ("prefix_median_impute", "cosine_topk", "cosine_topk_blocked", "search_requests",
                "match_pipeline", "kmeans_step", "knn_search", "price_index_range", "emissions_report"):
        p = _plan(spark, qs, key)
        assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p, key


def test_batching_has_no_single_partition_exchange(spark, qs):
    for key in ("token_budget_batches", "fixed_batches", "surrogate_key"):
        assert "SinglePartition" not in _plan(spark, qs, key), key


def test_flagship_aggregates_before_small_joins(spark, qs):
    df = qs["emissions_report"](spark, SF_SMALL)
    p = df._jdf.queryExecution().optimizedPlan().toString()
    # the join with the (broadcast) rate lookup sits above an Aggregate of the lines
    assert p.count("Aggregate") >= 3
    assert "Join LeftOuter" in p


def test_filter_and_projection_reach_the_scan(spark, qs):
    p = _plan(spark, qs, "filter_entity")
    assert "o_orderpriority" in p and "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,1-URGENT)" in p \
        or "EqualTo(o_orderpriority,1-URGENT)" in p
    s = qs["scan_source"](spark, SF_SMALL)
    assert len(s.columns) == 5


def test_top_n_windows_limit_before_the_shuffle(spark, qs):
    # a partial WindowGroupLimit keeps n rows per group in every map task, so a
    # group holding a third of all rows never reaches one task whole
    for key in ("cosine_topk_blocked", "cluster_reps_nearest", "choose_match", "cluster_titles"):
        assert "WindowGroupLimit" in _plan(spark, qs, key), key


def test_bucketed_fact_tables_join_without_shuffle(spark):
    from ledgerlink.sources.files import write_bucketed
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_extendedprice")
    od = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_custkey")
    import tempfile
    a = write_bucketed(li, "ll_lineitem_b", "l_orderkey", 8, path=tempfile.mkdtemp(prefix="ll-bucket-"))
    b = write_bucketed(od, "ll_orders_b", "o_orderkey", 8, path=tempfile.mkdtemp(prefix="ll-bucket-"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = a.join(b, a.l_orderkey == b.o_orderkey)
        p = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in p and "Exchange" not in p
        assert j.count() == li.join(od, li.l_orderkey == od.o_orderkey).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
