"""Gradient boosting in blocks of rounds over a stored margin column.

A long fit (hundreds of rounds over a large table) should not live in one
job's memory. Here the encoded rows are written once with their current
prediction (``margin``); a block of rounds fits one regression tree a round
on the residuals, then its trees and the rows with their new margin are
written to the fit's folder and the former rows are released. A fit that
was stopped goes on after its last finished block, and lost executors cost
at most the running round's work.

The rounds are those of squared-error boosting as Spark ML does it: the first
tree is fitted to the label and weighs 1, every later one to twice the
residual and weighs the learning rate. The margin is added up tree by tree in
the same order whatever the blocks are, so block sizes do not change a fit.
With a validation indicator the validation error of every round of a block
is measured in one pass, and rounds stop by Spark ML's rule.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURES, LABEL, MARGIN, HELD = "features", "label", "margin", "held_out"


@dataclass(frozen=True)
class Boosting:
    """Parameters of a fit; ``tolerance`` is that of Spark ML's early stop."""

    rounds: int = 20
    depth: int = 5
    learning_rate: float = 0.1
    max_bins: int = 32
    min_instances: int = 1
    subsampling: float = 1.0
    seed: int = 42
    tolerance: float = 0.01

    def __post_init__(self):
        if self.rounds < 1 or not 0 < self.learning_rate <= 1 or not 0 < self.subsampling <= 1:
            raise ValueError(f"bad boosting parameters: {self}")


class _Folder:
    """Files of one fit, on whatever file system its URI names."""

    def __init__(self, spark: SparkSession, uri: str):
        self.spark, self.uri = spark, uri.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.uri}/{name}"

    def _fs(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def exists(self, name: str) -> bool:
        fs, path = self._fs(name)
        return fs.exists(path)

    def release(self, name: str) -> None:
        fs, path = self._fs(name)
        fs.delete(path, True)

    def write_json(self, name: str, value: object) -> None:
        self.spark.createDataFrame([(json.dumps(value),)], "value string").coalesce(1).write.mode("overwrite").text(
            self.path(name))

    def read_json(self, name: str) -> object:
        return json.loads(self.spark.read.text(self.path(name)).first()[0])


def ensemble(trees: list[DecisionTreeRegressionModel], weights: list[float], num_features: int,
             prediction_col: str = "prediction") -> GBTRegressionModel:
    """A Spark ML boosting model from single trees (saves and loads as usual)."""
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    jvm = sc._jvm.org.apache.spark.ml
    array = sc._gateway.new_array(jvm.regression.DecisionTreeRegressionModel, len(trees))
    for i, t in enumerate(trees):
        array[i] = t._java_obj
    w = sc._gateway.new_array(sc._jvm.double, len(weights))
    for i, x in enumerate(weights):
        w[i] = float(x)
    uid = jvm.util.Identifiable.randomUID("GBTRegressor")
    model = GBTRegressionModel(jvm.regression.GBTRegressionModel(uid, array, w, num_features))
    model._resetUid(uid)
    return model.setFeaturesCol(FEATURES).setPredictionCol(prediction_col)


def _margin(rows: DataFrame, trees: list[DecisionTreeRegressionModel], weights: list[float]) -> tuple[DataFrame, Column]:
    """Rows with the block's tree predictions, and the margin after them."""
    margin = F.col(MARGIN)
    for i, (t, w) in enumerate(zip(trees, weights)):
        rows = t.copy({t.predictionCol: f"_t{i}"}).transform(rows)
        margin = margin + F.lit(w) * F.col(f"_t{i}")
    return rows, margin


def _errors(rows: DataFrame, trees: list, weights: list[float]) -> list[float]:
    """Mean squared validation error after each tree of a block (one aggregate)."""
    out, margins = rows, []
    for i in range(len(trees)):
        out, m = _margin(rows, trees[:i + 1], weights[:i + 1])
        margins.append(m)
    row = out.agg(*[F.avg((F.col(LABEL) - m) * (F.col(LABEL) - m)).alias(f"e{i}") for i, m in enumerate(margins)]).first()
    return [row[f"e{i}"] for i in range(len(trees))]


def fit_boosted(data: DataFrame, params: Boosting, folder: str, held_out: Column | None = None,
                block_rounds: int = 10) -> GBTRegressionModel:
    """Fit a boosting model on ``features`` (vector) and ``label`` (double).

    ``folder`` keeps the fit: its parameters, the rows with their margin, one
    entry per finished block. Called again with the same folder it goes on
    where it was left (other parameters than the stored ones are refused);
    ``block_rounds`` may differ. Rows of ``held_out`` are not fitted; with it
    the number of trees is that of the best round when an improvement first
    falls under ``tolerance``. A NULL label fails the fit; an empty table is refused.
    """
    spark = data.sparkSession
    box = _Folder(spark, folder)
    said = {**vars(params), "held_out": held_out is not None}
    if box.exists("params/_SUCCESS"):
        if (stored := box.read_json("params")) != said:
            raise ValueError(f"the folder holds a fit with other parameters: {stored}")
    else:
        label = F.coalesce(F.col(LABEL).cast("double"), F.raise_error(F.lit("NULL label in training rows")).cast("double"))
        held = F.lit(False) if held_out is None else F.coalesce(held_out.cast("boolean"), F.lit(False))
        data.select(FEATURES, label.alias(LABEL), held.alias(HELD), F.lit(0.0).alias(MARGIN)).write.mode(
            "overwrite").parquet(box.path("rows-0"))
        first = spark.read.parquet(box.path("rows-0")).where(~F.col(HELD)).select(FEATURES).first()
        if first is None:
            raise ValueError("no training rows")
        box.write_json("state-0", {"rounds": 0, "best": None, "best_rounds": 0, "done": False,
                                   "num_features": first[0].size})
        box.write_json("params", said)

    k = 0
    while box.exists(f"state-{k + 1}/_SUCCESS"):
        k += 1
    state = box.read_json(f"state-{k}")
    while not state["done"]:
        rows = spark.read.parquet(box.path(f"rows-{k}"))
        trees: list[DecisionTreeRegressionModel] = []
        weights: list[float] = []
        last = min(params.rounds, state["rounds"] + block_rounds)
        for m in range(state["rounds"], last):
            now, margin = _margin(rows.where(~F.col(HELD)), trees, weights)
            target = F.col(LABEL) if m == 0 else F.lit(2.0) * (F.col(LABEL) - margin)
            if params.subsampling < 1:
                now = now.sample(False, params.subsampling, params.seed + m)
            tree = DecisionTreeRegressor(featuresCol=FEATURES, labelCol="_target", maxDepth=params.depth,
                                         maxBins=params.max_bins, minInstancesPerNode=params.min_instances,
                                         seed=params.seed + m).fit(now.select(FEATURES, target.alias("_target")))
            trees.append(tree)
            weights.append(1.0 if m == 0 else params.learning_rate)
        state = {**state, "rounds": last, "done": last >= params.rounds}
        if held_out is None:
            state["best_rounds"] = last
        else:
            for i, e in enumerate(_errors(rows.where(F.col(HELD)), trees, weights)):
                m = last - len(trees) + i
                if e is None:  # no held-out rows: nothing to stop by
                    state["best_rounds"] = m + 1
                elif state["best"] is not None and state["best"] - e < params.tolerance * max(e, 0.01):
                    state["done"] = True
                    break
                elif state["best"] is None or e < state["best"]:
                    state["best"], state["best_rounds"] = e, m + 1
        ensemble(trees, weights, state["num_features"]).write().overwrite().save(box.path(f"block-{k + 1}"))
        if not state["done"]:
            out, margin = _margin(rows, trees, weights)
            out.select(FEATURES, LABEL, HELD, margin.alias(MARGIN)).write.mode("overwrite").parquet(
                box.path(f"rows-{k + 1}"))
        box.write_json(f"state-{k + 1}", state)
        box.release(f"rows-{k}")
        k += 1

    trees, weights = [], []
    for i in range(1, k + 1):
        block = GBTRegressionModel.load(box.path(f"block-{i}"))
        trees += block.trees
        weights += list(block.treeWeights)
    n = max(1, state["best_rounds"])
    return ensemble(trees[:n], weights[:n], state["num_features"])


def fit_progress(spark: SparkSession, folder: str) -> Mapping[str, object]:
    """State of a fit's last finished block."""
    box, k = _Folder(spark, folder), 0
    while box.exists(f"state-{k + 1}/_SUCCESS"):
        k += 1
    return {"blocks": k, **box.read_json(f"state-{k}")}
