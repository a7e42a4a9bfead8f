"""Plan-shape checks: the properties the design relies on at scale."""

import contextlib
import importlib
import io

from pyspark.sql import functions as F

from tabforge.operators import quality, split
from conftest import SF_SMALL

LAZY = ["prepare_training", "preprocess", "to_numeric", "impute_mean", "fill_category",
        "select_features", "cast_columns", "null_counts", "conditional_counts", "category_domains",
        "regression_metrics", "dataset_fingerprint", "key_violations", "param_conflicts",
        "train_test_split", "bucket_split", "feature_lookup", "run_maps", "run_search",
        "latest_runs", "latest_per_status", "latest_version", "metric_latest", "map_scorer"]


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_no_cartesian_or_nested_loop_joins(spark):
    E = importlib.import_module("__spark_entry__")
    q = E.queries()
    for name in LAZY:
        s = _plan(q[name](spark, SF_SMALL))
        assert "CartesianProduct" not in s and "BroadcastNestedLoopJoin" not in s, name


def test_scans_are_pruned(spark):
    E = importlib.import_module("__spark_entry__")
    s = _plan(E.queries()["to_numeric"](spark, SF_SMALL))
    # frontage needs o_orderkey and o_custkey only
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in s


def test_split_main_pass_is_narrow(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    s = _plan(split.hash_split(df, "o_orderkey").select("o_orderkey", "o_totalprice", "split"))
    main = s.split("===== Subqueries =====")[0]
    # full rows are never shuffled: the main plan has no exchange, no window, no join
    for op in ("Exchange", "Window", "Join"):
        assert op not in main, op


def test_snapshot_diff_never_joins_the_snapshots(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(
        F.col("o_orderkey").alias("id"), "o_orderstatus")
    s = _plan(quality.snapshot_diff(o, o.where("id > 10"), "id", materialize=False))
    # both snapshots meet in a Union feeding one aggregation on the full row;
    # no join ever pairs old rows with new rows
    main = s.split("===== Subqueries =====")[0]
    assert "Union" in main and "HashAggregate" in main
    assert "CartesianProduct" not in main and "BroadcastNestedLoopJoin" not in main


def test_bucketed_training_set_join_is_shuffle_free(spark):
    E = importlib.import_module("__spark_entry__")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        s = _plan(E.queries()["training_set_bucketed"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    main = s.split("===== Subqueries =====")[0]
    assert "SortMergeJoin" in main and "Exchange" not in main
    assert "Bucketed: true" in s


def test_split_views_prune_partitions(spark):
    from tabforge.jobs import Namespace, process_data
    from tabforge.plans.derived import ORDERS_SPEC, raw_orders

    ns = Namespace(schema="tf_prune_test")
    train_v, _ = process_data(spark, raw_orders(spark, SF_SMALL), ORDERS_SPEC, ns)
    s = _plan(spark.table(train_v).select("id", "target"))
    assert "PartitionFilters: [isnotnull(split" in s and "(split" in s and "= train)" in s
    assert "ReadSchema: struct<target:double,id:string>" in s
    spark.sql("DROP DATABASE tf_prune_test CASCADE")


def test_preprocess_shuffles_no_full_rows(spark):
    E = importlib.import_module("__spark_entry__")
    s = _plan(E.queries()["preprocess"](spark, SF_SMALL))
    main, subqueries = s.split("===== Subqueries =====")
    assert "Exchange" not in main
    # the mean is one global aggregate: partial per partition, one-row final merge
    assert "partial_avg" in subqueries and "SinglePartition" in subqueries


def test_key_violations_single_key_shuffle_after_partial_agg(spark):
    E = importlib.import_module("__spark_entry__")
    s = _plan(E.queries()["key_violations"](spark, SF_SMALL))
    assert s.count("Exchange (") == 1 or s.count("+- Exchange") == 1
    assert "hashpartitioning(l_orderkey" in s and "partial_count" in s
