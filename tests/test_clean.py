import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabforge.operators import clean
from tabforge.spec import FeatureSpec

SPEC = FeatureSpec(num=("a", "m"), cat=("c",), target="y", id_col="id",
                   mean_fill=("a",), constant_fill={"m": 0.0})


def test_impute_mean_skips_nan_and_null(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, 3.0), (4, None)], "id int, x double")
    df = clean.nan_to_null_all(df)
    out = clean.impute_mean(df, ["x"]).orderBy("id").collect()
    assert [r.x for r in out] == [1.0, 2.0, 3.0, 2.0]


def test_impute_median_exact_interpolated(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 4.0), (4, 10.0), (5, None)], "id int, x double")
    out = clean.impute_median(df, ["x"]).where("id = 5").first().x
    assert out == 3.0


def test_impute_constant_and_category(spark):
    df = spark.createDataFrame([(1, None, None), (2, 5.0, "a")], "id int, m double, c string")
    out = clean.fill_category(clean.impute_constant(df, {"m": 0}), ["c"]).orderBy("id").collect()
    assert [(r.m, r.c) for r in out] == [(0.0, "None"), (5.0, "a")]


def test_require_columns_lists_all_missing(spark):
    empty = spark.createDataFrame([], "z int")
    with pytest.raises(ValueError) as e:
        clean.preprocess(empty, SPEC)
    for c in ("a", "m", "c", "y", "id"):
        assert repr(c) in str(e.value)


def test_preprocess_contract(spark):
    df = spark.createDataFrame(
        [(1, "10", None, None, 100.0, "x"), (2, "NA", 4.0, "b", 200.0, "y"), (3, "20", 2.0, "a", 300.0, "z")],
        "id long, a string, m double, c string, y double, extra string",
    )
    out = clean.preprocess(df, SPEC)
    assert out.columns == ["c", "a", "m", "y", "id"]
    assert dict(out.dtypes)["id"] == "string"
    rows = {r.id: r for r in out.collect()}
    assert rows["2"].a == 15.0            # mean of 10 and 20
    assert rows["1"].m == 0.0 and rows["1"].c == "None"
    assert out.where(F.col("a").isNull()).count() == 0


def test_schema_conform(spark):
    df = spark.createDataFrame([(1, "2", "x")], "a int, b string, extra string")
    from pyspark.sql.types import StructType

    target = StructType.fromDDL("a long, b int")
    out = clean.schema_conform(df, target)
    assert out.dtypes == [("a", "bigint"), ("b", "int")]
    with pytest.raises(ValueError):
        clean.schema_conform(df.drop("b"), target)


def test_audit_stamp_fixed_and_now(spark):
    df = spark.range(2)
    fixed = clean.audit_stamp(df, as_of=dt.datetime(2025, 1, 1))
    assert {r.update_timestamp_utc for r in fixed.collect()} == {dt.datetime(2025, 1, 1)}
    now = clean.audit_stamp(df).first().update_timestamp_utc
    utc_now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert abs((utc_now - now).total_seconds()) < 120


def test_impute_median_approx_mode(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 4.0), (4, None)], "id int, x double")
    out = clean.impute_median(df, ["x"], approx=True).where("id = 4").first().x
    assert out == 2.0


def test_impute_mean_int_column_becomes_double(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, None)], "id int, x int")
    out = clean.impute_mean(df, ["x"])
    assert dict(out.dtypes)["x"] == "double"
    assert out.where("id = 3").first().x == 1.5


def test_impute_mean_fit_on_other_frame(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 9.0), (3, None)], "id int, x double")
    train = df.where("id = 1")
    assert clean.impute_mean(df, ["x"], fit_df=train).where("id = 3").first().x == 1.0
    assert clean.impute_median(df, ["x"], fit_df=train).where("id = 3").first().x == 1.0
