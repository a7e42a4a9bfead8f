"""Boosting in blocks: the same model whatever the blocks, resumable, stopped by held-out rows."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tabforge.operators import boosting as B
from tabforge.operators import model
from tabforge.plans.derived import PART_SPEC
from tabforge.session import scratch_path


@pytest.fixture(scope="module")
def rows(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(
        (F.col("o_custkey") % 23).cast("double").alias("a"), (F.col("o_orderkey") % 17).cast("double").alias("b"),
        F.col("o_totalprice").alias("label"), (F.col("o_orderkey") % 5 == 0).alias("check"), F.col("o_orderkey").alias("id"))
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(o)


def predictions(m, rows):
    return {r.id: r.prediction for r in m.transform(rows).select("id", "prediction").collect()}


def test_blocks_do_not_change_the_fit_and_equal_spark_ml(spark, rows):
    p = B.Boosting(rounds=5, depth=3, learning_rate=0.3)
    whole = predictions(B.fit_boosted(rows, p, scratch_path(spark, "b"), block_rounds=5), rows)
    parts = predictions(B.fit_boosted(rows, p, scratch_path(spark, "b"), block_rounds=2), rows)
    assert whole == parts and len(set(whole.values())) > 5  # bit for bit
    ml = GBTRegressor(maxIter=5, maxDepth=3, stepSize=0.3, seed=42, labelCol="label").fit(rows)
    assert predictions(ml, rows) == pytest.approx(whole, rel=1e-12)


def test_a_stopped_fit_goes_on(spark, rows, monkeypatch):
    p, folder = B.Boosting(rounds=4, depth=2, learning_rate=0.5), scratch_path(spark, "b")
    want = predictions(B.fit_boosted(rows, p, scratch_path(spark, "b")), rows)
    plain, calls = B.ensemble, []

    def breaks(trees, *a, **k):
        calls.append(len(trees))
        if len(calls) == 2:
            raise RuntimeError("executor lost")
        return plain(trees, *a, **k)

    monkeypatch.setattr(B, "ensemble", breaks)
    with pytest.raises(RuntimeError):
        B.fit_boosted(rows, p, folder, block_rounds=2)
    assert B.fit_progress(spark, folder)["rounds"] == 2
    with pytest.raises(ValueError, match="other parameters"):
        B.fit_boosted(rows, B.Boosting(rounds=4, depth=3, learning_rate=0.5), folder)
    calls.append(0)  # from here on nothing breaks
    again = B.fit_boosted(rows.where("false"), p, folder, block_rounds=1)  # rows come from the folder
    assert predictions(again, rows) == want
    assert calls == [2, 2, 0, 1, 1, 4] and again.treeWeights == [1.0, 0.5, 0.5, 0.5]
    assert not B._Folder(spark, folder).exists("rows-0")  # former rows are released


def test_early_stop_equals_spark_ml(spark, rows):
    p = B.Boosting(rounds=12, depth=4, learning_rate=0.4, tolerance=0.01)
    m = B.fit_boosted(rows, p, scratch_path(spark, "b"), held_out=F.col("check"), block_rounds=4)
    ml = GBTRegressor(maxIter=12, maxDepth=4, stepSize=0.4, seed=42, labelCol="label", validationIndicatorCol="check",
                      validationTol=0.01).fit(rows)
    assert 0 < m.getNumTrees < 12 and m.getNumTrees == ml.getNumTrees
    assert predictions(m, rows) == pytest.approx(predictions(ml, rows), rel=1e-12)


def test_saves_as_an_ordinary_model(spark, rows):
    m = B.fit_boosted(rows, B.Boosting(rounds=2, depth=2), scratch_path(spark, "b"))
    path = scratch_path(spark, "m")
    m.save(path)
    back = GBTRegressionModel.load(path)
    assert back.numFeatures == 2 and predictions(back, rows) == predictions(m, rows)


def test_refusals(spark, rows):
    with pytest.raises(Exception, match="NULL label"):
        B.fit_boosted(rows.withColumn("label", F.when(F.col("id") > 9, F.col("label"))), B.Boosting(), scratch_path(spark, "b"))
    with pytest.raises(ValueError, match="no training rows"):
        B.fit_boosted(rows.where("false"), B.Boosting(), scratch_path(spark, "b"))
    with pytest.raises(ValueError, match="bad boosting"):
        B.Boosting(rounds=0)
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet").withColumn("p_retailprice", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="NULL label"):
        model.train_gbt(part, PART_SPEC, {"n_estimators": 1})


def test_parameter_names():
    assert model.boosting({"learning_rate": 0.01, "n_estimators": 1000, "max_depth": 6, "seed": 7}) == B.Boosting(
        rounds=1000, depth=6, learning_rate=0.01, seed=7)
