"""Fitted-model sink and source, and model-version resolution."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tabforge.operators.runs import latest_version


def save_model(model: PipelineModel, path: str) -> str:
    """Persist a fitted pipeline (stages written by the executors/driver)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_latest(versions: DataFrame, name: str) -> PipelineModel:
    """Resolve the latest version of ``name`` (one bounded row) and load it."""
    row = latest_version(versions, name).select("path").first()
    if row is None:
        raise ValueError(f"no registered versions for {name!r}")
    return PipelineModel.load(row["path"])


def save_schema(spark: SparkSession, schema: T.StructType, path: str) -> str:
    """Store a schema contract (JSON text, one tiny file) on shared storage."""
    spark.createDataFrame([(schema.json(),)], "schema string").coalesce(1).write.mode(
        "overwrite").text(path)
    return path


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    row = spark.read.text(path).first()
    return T.StructType.fromJson(json.loads(row[0]))


def schema_path(model_path: str) -> str:
    return model_path.rstrip("/") + "_input_schema"


def output_schema_path(model_path: str) -> str:
    return model_path.rstrip("/") + "_output_schema"


def example_path(model_path: str) -> str:
    return model_path.rstrip("/") + "_input_example"


def save_example(rows: DataFrame, key: str, path: str) -> str:
    """Store the first row by ``key`` as the model's input example (JSON)."""
    rows.orderBy(key).limit(1).coalesce(1).write.mode("overwrite").json(path)
    return path


def load_example(spark: SparkSession, model_path: str) -> DataFrame:
    """The stored example with the types of the input contract."""
    return spark.read.schema(load_schema(spark, schema_path(model_path))).json(example_path(model_path))
