"""Golden values recorded in FIXTURES.md for the driver tables at sf0.01."""

import importlib

from pyspark.sql import functions as F

from conftest import SF_MID


def test_split_golden(spark):
    q = importlib.import_module("__spark_entry__").queries()
    test = q["train_test_split"](spark, SF_MID).where("split = 'test'")
    r = test.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("id").cast("bigint")).alias("s")).first()
    assert (r.n, r.s) == (3000, 22444710)
    assert q["bucket_split"](spark, SF_MID).where("split = 'test'").count() == 3025


def test_metrics_golden(spark):
    q = importlib.import_module("__spark_entry__").queries()
    r = q["regression_metrics"](spark, SF_MID).first()
    assert r.n == 60000
    assert round(r.mae, 6) == 32628.947296 and round(r.r2, 8) == -0.75990665


def test_clean_domains_golden(spark):
    # after the fill: priority has 6 values (5 + 'None' on 1,667 rows), status 3
    q = importlib.import_module("__spark_entry__").queries()
    df = q["preprocess"](spark, SF_MID)
    assert df.select("priority").distinct().count() == 6
    assert df.where("priority = 'None'").count() == 1667
    assert df.select("status").distinct().count() == 3
