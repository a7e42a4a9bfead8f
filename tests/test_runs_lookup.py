import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabforge.functions.sql_udf import register_age_function
from tabforge.operators import lookup, runs


def test_metric_latest_stepped(spark):
    # (3.0, 0), (3.5, 1), (4.0, 2) -> latest 4.0
    df = spark.createDataFrame([("r", "metric1", 3.5, 1), ("r", "metric1", 4.0, 2), ("r", "metric1", 3.0, 0)],
                               "run_id string, key string, value double, step long")
    r = runs.metric_latest(df).first()
    assert (r.value, r.step) == (4.0, 2)


def test_run_maps_and_search(spark):
    t0 = dt.datetime(2025, 1, 1)
    r1, m1, p1 = runs.record_run(spark, "a", {"type": "demo"}, {"metric3": 3.0}, {"branch": "w2"},
                                 run_name="demo-run-extra", start_time=t0)
    r2, m2, p2 = runs.record_run(spark, "b", {"type": "x"}, {"metric1": 1.0}, run_name="other",
                                 start_time=t0 + dt.timedelta(hours=2))
    maps = runs.run_maps(m1.unionByName(m2), p1.unionByName(p2))
    allruns = r1.unionByName(r2).join(maps, "run_id")
    hit = runs.run_search(allruns, "status = 'FINISHED' AND run_name LIKE '%demo-run%' "
                                   "AND try_element_at(metrics, 'metric3') > 0").collect()
    assert [h.run_id for h in hit] == ["a"]
    assert hit[0].params == {"type": "demo"}
    latest = runs.latest_runs(allruns, 1).first()
    assert latest.run_id == "b"


def test_metrics_dataframe_recorded_without_collect(spark):
    m = spark.createDataFrame([(1.5, 2.5)], "mse double, mae double")
    _, met, _ = runs.record_run(spark, "r", metrics=m, start_time=dt.datetime(2025, 1, 1))
    assert {(r.key, r.value) for r in met.collect()} == {("mse", 1.5), ("mae", 2.5)}


def test_versions(spark):
    v = runs.next_version_row(spark, None, "m", "r1", "/p1")
    v = v.unionByName(runs.next_version_row(spark, v, "m", "r2", "/p2"))
    latest = runs.latest_version(v, "m").first()
    assert (latest.version, latest.path, latest.run_id) == (2, "/p2", "r2")


def test_latest_per_group(spark):
    df = spark.createDataFrame([("a", "g1", 1), ("b", "g1", 3), ("c", "g2", 2)],
                               "run_id string, g string, start_time int")
    got = {(r.g, r.run_id) for r in runs.latest_per_group(df, "g").collect()}
    assert got == {("g1", "b"), ("g2", "c")}


def test_lookup_left_unmatched_and_clash(spark):
    base = spark.createDataFrame([("1", 10.0), ("2", 20.0)], "Id string, y double")
    feats = spark.createDataFrame([("1", 7, 100)], "Id string, OverallQual int, GrLivArea int")
    lk = lookup.Lookup(feats, ("OverallQual", "GrLivArea"), "Id")
    out = {r.Id: r for r in lookup.feature_lookup(base, lk).collect()}
    assert out["1"].OverallQual == 7 and out["2"].OverallQual is None
    with pytest.raises(ValueError):
        lookup.feature_lookup(base.withColumn("OverallQual", F.lit(1)), lk)


def test_training_set_with_sql_function(spark):
    register_age_function(spark, "age_fn", as_of_year=2025)
    base = spark.createDataFrame([("1", 2000, 5.0, None)], "Id string, YearBuilt int, y double, update_timestamp_utc timestamp")
    feats = spark.createDataFrame([("1", 7)], "Id string, OverallQual int")
    ts = lookup.training_set(
        base, "y", [lookup.Lookup(feats, ("OverallQual",), "Id")],
        [lookup.FunctionFeature("age_fn", "house_age", {"year_built": "YearBuilt"})],
        exclude_columns=["update_timestamp_utc"],
    )
    r = ts.first()
    assert (r.OverallQual, r.house_age) == (7, 25) and "update_timestamp_utc" not in ts.columns
    # NULL input -> NULL output (no Python UDF failure)
    assert spark.sql("SELECT age_fn(CAST(NULL AS INT)) AS a").first().a is None


def test_lookup_hot_key_split_same_result(spark):
    # one key holds a third of the rows
    rows = [(i, 7 if i % 3 == 0 else i % 50) for i in range(3000)]
    base = spark.createDataFrame(rows, "rid int, k int")
    feats = spark.createDataFrame([(k, float(k) * 10) for k in range(40)], "k int, f double")
    lk = lookup.Lookup(feats, ("f",), "k")
    plain = sorted(tuple(r) for r in lookup.feature_lookup(base, lk).select("rid", "k", "f").collect())
    split_ = sorted(tuple(r) for r in lookup.feature_lookup(base, lk, hot_key_fraction=0.05)
                    .select("rid", "k", "f").collect())
    assert plain == split_ and len(plain) == 3000
    hot = {r.k for r in lookup.hot_keys(base, "k", 0.05).collect()}
    assert 7 in hot and len(hot) <= 20


def test_hot_lookup_with_map_column(spark):
    base = spark.createDataFrame([(i, 1 if i % 2 else i, {"a": "b"}) for i in range(200)],
                                 "rid int, k int, m map<string,string>")
    feats = spark.createDataFrame([(1, 5.0)], "k int, f double")
    out = lookup.feature_lookup(base, lookup.Lookup(feats, ("f",), "k"), hot_key_fraction=0.2)
    assert out.count() == 200 and out.where("f = 5.0").count() == 100


def test_hot_lookup_null_keys_stay_unmatched(spark):
    rows = [(i, None if i % 4 == 0 else (3 if i % 2 else i % 10)) for i in range(400)]
    base = spark.createDataFrame(rows, "rid int, k int")
    feats = spark.createDataFrame([(k, float(k)) for k in range(10)], "k int, f double")
    out = lookup.feature_lookup(base, lookup.Lookup(feats, ("f",), "k"), hot_key_fraction=0.1)
    assert out.count() == 400
    assert out.where("k IS NULL AND f IS NOT NULL").count() == 0
    assert out.where("k = 3").where("f = 3.0").count() == 200


def _lookup_frames(spark):
    """Half of the keys NULL, a third of the rest one key, some unmatched."""
    rows = [(i, None if i % 2 else (7 if i % 3 == 0 else i % 60)) for i in range(6000)]
    base = spark.createDataFrame(rows, "rid int, k int")
    feats = spark.createDataFrame([(k, float(k) * 10, str(k)) for k in range(40)] + [(None, -1.0, "no key")],
                                  "k int, f double, g string")
    return rows, base, feats


def test_hot_and_missing_keys_are_spread(spark):
    rows, base, feats = _lookup_frames(spark)
    prev = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = lookup.feature_lookup(base, lookup.Lookup(feats, ("f", "g"), "k"), hot_key_fraction=0.05)
        got = out.withColumn("task", F.spark_partition_id()).collect()
        plain = lookup.feature_lookup(base, lookup.Lookup(feats, ("f", "g"), "k")).withColumn(
            "task", F.spark_partition_id()).collect()
    finally:
        for c, v in prev.items():
            spark.conf.set(c, v)
    want = sorted(((i, k, float(k) * 10 if k is not None and k < 40 else None) for i, k in rows))
    assert sorted((r.rid, r.k, r.f) for r in got) == want == sorted((r.rid, r.k, r.f) for r in plain)
    from collections import Counter

    per = Counter(r.task for r in got)
    assert len(per) == 4 and max(per.values()) < 1.3 * 6000 / 4  # even over the tasks
    assert max(Counter(r.task for r in plain).values()) > 3000  # without it one task holds the NULL keys


def test_lookup_inner_and_bad_kinds(spark):
    rows, base, feats = _lookup_frames(spark)
    lk = lookup.Lookup(feats, ("f",), "k")
    n = sum(k is not None and k < 40 for _, k in rows)
    assert lookup.feature_lookup(base, lk, "inner").count() == n
    assert lookup.feature_lookup(base, lk, "inner", hot_key_fraction=0.05).count() == n
    with pytest.raises(ValueError):
        lookup.feature_lookup(base, lk, "full")


def test_repeated_feature_keys_are_refused(spark):
    _, base, feats = _lookup_frames(spark)
    twice = feats.unionByName(spark.createDataFrame([(7, 0.0, "again")], "k int, f double, g string"))
    for fraction in (None, 0.05):
        with pytest.raises(Exception, match="repeats key 7"):
            lookup.feature_lookup(base, lookup.Lookup(twice, ("f",), "k"), hot_key_fraction=fraction).collect()
