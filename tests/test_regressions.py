"""Wrong answers of an earlier version, each with the input that showed it."""

import pytest
from pyspark.sql import functions as F

from tabforge.operators import clean, model, runs
from tabforge.plans.derived import ORDERS_SPEC


def test_latest_metric_on_equal_steps(spark):
    rows = [("r", "m", 9.0, 0, "2024-01-02"), ("r", "m", 1.0, 0, "2024-01-01")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "run_id string, key string, value double, step long, ts string")
        assert [tuple(r) for r in runs.metric_latest(df).collect()] == [("r", "m", 9.0, 0)]
        assert runs.metric_latest(df.drop("ts")).first().value == 9.0


def test_number_beyond_double_is_null(spark):
    df = spark.createDataFrame([("1e400",), ("-1e400",), ("1e3",)], "a string")
    assert [r.a for r in clean.coerce_numeric(df, ["a"]).collect()] == [None, None, 1000.0]


def test_booleans_are_numbers(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "a boolean")
    assert [r.a for r in clean.coerce_numeric(df, ["a"]).collect()] == [1.0, 0.0, None]


def test_missing_statistic_raises(spark):
    cols = [ORDERS_SPEC.id_col, ORDERS_SPEC.target, *ORDERS_SPEC.num, *ORDERS_SPEC.cat, *ORDERS_SPEC.extra_numeric]
    df = spark.range(1).select(*[F.lit("1").alias(c) for c in dict.fromkeys(cols)])
    with pytest.raises(ValueError, match="statistic"):
        clean.preprocess(df, ORDERS_SPEC, stats={})


def test_unknown_boosting_parameter_raises():
    with pytest.raises(ValueError, match="num_leaves"):
        model.gbt_params({"num_leaves": 31})
