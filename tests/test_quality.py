from collections import Counter

from pyspark.sql import functions as F

from tabforge.operators import quality


def test_key_violations_duplicate_and_null(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,), (3,)], "id int")
    rows = {(r.id, r.n_rows, r.violation) for r in quality.key_violations(df, "id").collect()}
    assert rows == {(2, 2, "duplicate_key"), (None, 1, "null_key")}


def test_null_counts_one_pass(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, float("nan"), None)], "a int, b double, c string")
    got = {r.column_name: r.n_missing for r in quality.null_counts(df).collect()}
    assert got == {"a": 1, "b": 2, "c": 1}


def test_conditional_counts_and_shape(spark):
    df = spark.createDataFrame([("None", 0.0), ("a", 1.0), ("None", 0.0)], "c string, m double")
    r = quality.conditional_counts(df, {"n_none": F.col("c") == "None", "n_zero": F.col("m") == 0}).first()
    assert (r.n_none, r.n_zero) == (2, 2)
    s = quality.table_shape(df).first()
    assert (s.n_rows, s.n_columns) == (3, 2)


def _brute_diff(old, new):
    o = {r[0]: r for r in old}
    n = {r[0]: r for r in new}
    out = Counter()
    for k in o.keys() | n.keys():
        if k not in n:
            out[(o[k], "delete")] += 1
        elif k not in o:
            out[(n[k], "insert")] += 1
        elif o[k] != n[k]:
            out[(o[k], "update_preimage")] += 1
            out[(n[k], "update_postimage")] += 1
    return out


def test_snapshot_diff_matches_brute_force(spark):
    old = [(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (4, None, 4.0), (5, "e", 5.0)]
    new = [(1, "a", 1.0), (2, "b", 2.0), (4, None, 4.0), (5, "E", 5.0), (6, "f", 6.0)]
    schema = "id int, s string, v double"
    got = quality.snapshot_diff(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), "id")
    got = Counter(((r.id, r.s, r.v), r._change_type) for r in got.collect())
    assert got == _brute_diff(old, new)


def test_snapshot_diff_duplicate_keys_never_pair(spark):
    # A hot key present many times on both sides: changes are netted, not paired.
    old = [(7, "x")] * 50 + [(8, "y")]
    new = [(7, "x")] * 48 + [(8, "z")]
    schema = "id int, s string"
    got = quality.snapshot_diff(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), "id")
    c = Counter((r.id, r.s, r._change_type) for r in got.collect())
    assert c == Counter({(7, "x", "delete"): 2, (8, "y", "update_preimage"): 1,
                         (8, "z", "update_postimage"): 1})


def test_fingerprint_order_free(spark):
    df = spark.range(0, 500).select("id", (F.col("id") / 3).alias("x"), F.lit(None).cast("string").alias("s"))
    a = quality.dataset_fingerprint(df).first()
    b = quality.dataset_fingerprint(df.repartition(7).orderBy(F.desc("id"))).first()
    assert a == b and a.n_rows == 500
    c = quality.dataset_fingerprint(df.where("id != 3")).first()
    assert c.fingerprint != a.fingerprint


def test_param_conflicts(spark):
    df = spark.createDataFrame([("r1", "type", "demo"), ("r1", "type", "demo2"), ("r1", "p", "1"),
                                ("r2", "type", "demo")], "run_id string, key string, value string")
    rows = quality.param_conflicts(df).collect()
    assert [(r.run_id, r.key, r.n_values) for r in rows] == [("r1", "type", 2)]


def test_snapshot_diff_join_matches_aggregate_form(spark):
    old = [(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (4, None, 4.0), (5, "e", 5.0)]
    new = [(1, "a", 1.0), (2, "b", 2.0), (4, None, 4.0), (5, "E", 5.0), (6, "f", 6.0)]
    schema = "id int, s string, v double"
    o, n = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    a = Counter(tuple(r) for r in quality.snapshot_diff(o, n, "id").collect())
    b = Counter(tuple(r) for r in quality.snapshot_diff_join(o, n, "id").collect())
    assert a == b


def test_snapshot_diff_null_key_is_a_key_like_any_other(spark):
    schema = "id int, s string"
    old = spark.createDataFrame([(None, "a"), (1, "x")], schema)
    new = spark.createDataFrame([(None, "b"), (1, "x")], schema)
    got = Counter((r.id, r.s, r._change_type) for r in quality.snapshot_diff(old, new, "id").collect())
    assert got == Counter({(None, "a", "update_preimage"): 1, (None, "b", "update_postimage"): 1})


def test_fingerprint_survives_extreme_doubles(spark):
    df = spark.createDataFrame([(1e300,), (float("inf"),), (-2.5,)], "x double")
    r = quality.dataset_fingerprint(df).first()
    assert r.n_rows == 3 and all(int(p) > 0 for p in r.fingerprint.split("-"))


def test_snapshot_diff_join_refuses_duplicate_keys(spark):
    import pytest

    o = spark.createDataFrame([(1, "a"), (1, "b")], "id int, s string")
    n = spark.createDataFrame([(1, "a")], "id int, s string")
    with pytest.raises(ValueError):
        quality.snapshot_diff_join(o, n, "id")


def test_snapshot_diff_join_rows_without_a_key(spark):
    schema = "id int, s string"
    old = [(1, "a"), (2, "b"), (None, "x"), (None, "x"), (None, "y"), (3, "c")]
    new = [(1, "a"), (2, "B"), (None, "x"), (None, "z"), (4, "d")]
    o, n = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    got = Counter(tuple(r) for r in quality.snapshot_diff_join(o, n, "id").collect())
    assert got == Counter(tuple(r) for r in quality.snapshot_diff(o, n, "id").collect())
    same = spark.createDataFrame([(None, "x"), (5, "q")], schema)
    assert quality.snapshot_diff_join(same, same, "id").collect() == []


def test_many_repeats_are_counted_or_repeated(spark):
    old = spark.range(10_000).select(F.lit(1).alias("id"), F.lit("x").alias("s"))
    new = old.limit(0)
    assert [tuple(r) for r in quality.snapshot_diff(old, new, "id", counted=True).collect()] == [(1, "x", "delete", 10_000)]
    assert quality.snapshot_diff(old, new, "id").groupBy("id", "s", "_change_type").count().collect()[0]["count"] == 10_000


def test_bucketed_change_feed_has_no_exchange_and_many_tasks(spark):
    import contextlib
    import io

    from tabforge.sources import catalog

    df = spark.range(1000).select("id", (F.col("id") % 7).alias("v"))
    n = catalog.bucket_count(df, df)
    assert n > 8 and catalog.bucket_count(df, bucket_bytes=100) >= 100
    for name in ("t_bucket_old", "t_bucket_new"):
        catalog.save_table(df, name, bucket_by=(n, "id"))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = quality.snapshot_diff_join(spark.table("t_bucket_old"), spark.table("t_bucket_new"), "id")
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            out.explain("formatted")
        join = buf.getvalue().split("Union")[1].split("\n   +- ")[0]  # the keyed branch
        assert out.count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        for name in ("t_bucket_old", "t_bucket_new"):
            spark.sql(f"DROP TABLE {name}")
    assert "SortMergeJoin" in join and "Exchange" not in join


def test_column_report(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, "x", float("nan"))], "a int, b string, extra double")
    got = {tuple(r) for r in quality.column_report(df, ["a", "b", "gone"]).collect()}
    assert got == {("a", True, True, 0), ("b", True, True, 1), ("gone", True, False, None), ("extra", False, True, 1)}


def test_table_properties_round_trip(spark):
    from tabforge.sources import catalog

    catalog.save_table(spark.range(3), "t_props")
    catalog.set_table_properties(spark, "t_props", {"feed": "true", "it's": "a 'note'"})
    catalog.set_table_properties(spark, "t_props", {"feed": "false"})
    got = {r.key: r.value for r in catalog.table_properties(spark, "t_props").collect()}
    assert got["feed"] == "false" and got["it's"] == "a 'note'"
    spark.sql("DROP TABLE t_props")
