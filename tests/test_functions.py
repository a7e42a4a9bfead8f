import math

import pytest
from pyspark.sql import functions as F

from tabforge.functions import age_from_year, qualified_name, round_cents, scale_round
from tabforge.operators.clean import coerce_numeric, nan_to_null_all


def test_to_numeric_edge_strings(spark):
    # FIXTURES §5: only ' 65.0 ', '1e3', '.5', '5.', '+3' parse.
    vals = ["NA", " 65.0 ", "1e3", "inf", "nan", "1_0", "10d", "10f", "0x1F", "True", "",
            "1,000", ".5", "5.", "+3", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, s string")
    out = dict(coerce_numeric(df, ["s"]).select("i", "s").collect())
    parsed = {vals[i]: v for i, v in out.items() if v is not None}
    assert parsed == {" 65.0 ": 65.0, "1e3": 1000.0, ".5": 0.5, "5.": 5.0, "+3": 3.0}


def test_to_numeric_keeps_numeric_types(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 2.5)], "a int, b double")
    out = coerce_numeric(df, ["a", "b"])
    assert dict(out.dtypes) == {"a": "int", "b": "double"}
    assert [r.b for r in out.orderBy("a").collect()] == [None, 2.5]


def test_rounding_half_even_cents(spark):
    vals = [2.675, 0.125, 1.005, 1234.565, 0.285]
    df = spark.createDataFrame([(v,) for v in vals], "p double")
    rows = df.select(round_cents("p").alias("c"), scale_round("p", 1.3).alias("s")).collect()
    assert [r.c for r in rows] == [2.68, 0.12, 1.0, 1234.56, 0.28]
    assert [r.s for r in rows] == [3.48, 0.16, 1.31, 1604.93, 0.37]


def test_age_null_in_null_out(spark):
    df = spark.createDataFrame([(2000,), (None,)], "y int")
    assert [r.a for r in df.select(age_from_year("y", 2025).alias("a")).collect()] == [25, None]


def test_nan_to_null_all(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert [r.x for r in nan_to_null_all(df).collect()] == [1.0, None, None]
    m = nan_to_null_all(df).agg(F.avg("x")).first()[0]
    assert not math.isnan(m) and m == 1.0


def test_qualified_name():
    assert qualified_name("c", "s", "t") == "c.s.t"
    with pytest.raises(ValueError):
        qualified_name("c", "bad name")


def test_to_numeric_allow_inf(spark):
    df = spark.createDataFrame([("inf",), ("-Infinity",), ("3",), ("x",)], "s string")
    got = [r.s for r in coerce_numeric(df, ["s"], allow_inf=True).collect()]
    assert got[0] == float("inf") and got[1] == float("-inf") and got[2:] == [3.0, None]
    assert [r.s for r in coerce_numeric(df, ["s"]).collect()] == [None, None, 3.0, None]
    d = spark.createDataFrame([(float("inf"),), (1.0,)], "x double")
    assert [r.x for r in coerce_numeric(d, ["x"]).collect()] == [None, 1.0]
