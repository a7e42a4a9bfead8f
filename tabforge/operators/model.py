"""Gradient-boosted regression: fit, batch scoring, post-processing.

Fitting runs on the executors in blocks of rounds that are kept on shared
storage (see ``boosting``); scoring is a lazy ``transform`` of a Spark ML
pipeline. A user-supplied Python scorer runs through ``mapInPandas``
(Arrow batches), never row by row.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.numeric import round_cents
from tabforge.operators.boosting import Boosting, fit_boosted
from tabforge.operators.encode import assembler, fill_for_trees, one_hot_stages
from tabforge.session import scratch_path
from tabforge.spec import FeatureSpec


def gbt_params(params: Mapping[str, object]) -> dict:
    """Map the project's boosting parameters onto ``GBTRegressor`` names.

    ``force_row_wise`` (a histogram-layout switch of another library) has
    no counterpart and is left out with a warning; other unknown names raise.
    """
    known = {"learning_rate", "n_estimators", "max_depth", "force_row_wise",
             "maxBins", "subsamplingRate", "minInstancesPerNode", "seed"}
    if unknown := sorted(set(params) - known):
        raise ValueError(f"unknown boosting parameters: {unknown}")
    if "force_row_wise" in params:
        warnings.warn("force_row_wise has no counterpart here and is left out", stacklevel=2)
    out: dict = {}
    if "learning_rate" in params:
        out["stepSize"] = float(params["learning_rate"])
    if "n_estimators" in params:
        out["maxIter"] = int(params["n_estimators"])
    if "max_depth" in params:
        out["maxDepth"] = int(params["max_depth"])
    for k in ("maxBins", "subsamplingRate", "minInstancesPerNode", "seed"):
        if k in params:
            out[k] = params[k]
    return out


def boosting(params: Mapping[str, object] | None = None, seed: int = 42) -> Boosting:
    """The fit's parameters from the project's names (20 rounds of depth 5 by 0.1 where not given)."""
    names = {"stepSize": "learning_rate", "maxIter": "rounds", "maxDepth": "depth", "maxBins": "max_bins",
             "subsamplingRate": "subsampling", "minInstancesPerNode": "min_instances", "seed": "seed"}
    return Boosting(**{"seed": seed, **{names[k]: v for k, v in gbt_params(params or {}).items()}})


def model_input(df: DataFrame, spec: FeatureSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Key + features + label, numeric missing values made tree-safe."""
    label = [spec.target] if spec.target in df.columns and spec.target not in keep else []
    cols = list(dict.fromkeys([spec.id_col, *keep, *spec.num, *spec.cat, *label]))
    return fill_for_trees(df.select(*cols), spec.num)


def train_gbt(train: DataFrame, spec: FeatureSpec, params: Mapping[str, object] | None = None,
              seed: int = 42, folder: str | None = None, held_out: Column | None = None,
              block_rounds: int = 10) -> PipelineModel:
    """Fit the encoding + boosting pipeline on the training frame.

    One-hot(cat) -> assemble(one-hot + num) -> boosted trees on the target. A
    NULL label fails the fit. ``folder`` keeps the fit's blocks (a stopped
    fit with the same folder goes on; by default a new scratch folder);
    ``held_out`` marks rows that only decide when to stop early.
    """
    keep = [] if held_out is None else ["_held_out"]
    rows = train if held_out is None else train.withColumn("_held_out", held_out)
    data = model_input(rows, spec, keep)
    fitting = data if held_out is None else data.where(~F.coalesce("_held_out", F.lit(False)))
    encoder = Pipeline(stages=[*one_hot_stages(spec.cat), assembler(spec.cat, spec.num)]).fit(fitting)
    rows = encoder.transform(data).withColumn("label", F.col(spec.target))
    trees = fit_boosted(rows, boosting(params, seed), folder or scratch_path(train.sparkSession, "boosting"),
                        None if held_out is None else F.col("_held_out"), block_rounds)
    return PipelineModel([*encoder.stages, trees])


def batch_score(model: PipelineModel, df: DataFrame, spec: FeatureSpec,
                keep: Sequence[str] = ()) -> DataFrame:
    """``(key, *keep, prediction)`` for every input row (lazy transform)."""
    scored = model.transform(model_input(df, spec, keep))
    return scored.select(spec.id_col, *keep, "prediction")


def score_adjusted(model: PipelineModel, df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Prediction post-processed to cents (half-to-even)."""
    return batch_score(model, df, spec).withColumn("prediction", round_cents("prediction"))


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def map_scorer(df: DataFrame, key: str, predict: Callable[[pd.DataFrame], pd.Series],
               input_cols: Sequence[str], output: str = "prediction") -> DataFrame:
    """Run an opaque pandas scorer over Arrow batches (``mapInPandas``).

    ``predict`` receives a batch with ``input_cols`` and returns one value per
    row. Batches stream per partition; nothing is gathered.
    """
    cols = [key, *[c for c in input_cols if c != key]]
    src = df.select(*cols)
    key_type = src.schema[key].dataType.simpleString()

    def run(batches):
        for pdf in batches:
            pred = pd.Series(predict(pdf[list(input_cols)]), index=pdf.index).astype("float64")
            yield pd.DataFrame({key: pdf[key], output: pred})

    return src.mapInPandas(run, schema=f"{key} {key_type}, {output} double")
