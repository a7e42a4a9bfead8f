"""End-to-end jobs composed from the operators (the two batch entry points).

``process_data``: raw frame -> preprocess -> exact split -> audit stamp ->
ONE partitioned table write (``split`` column) + ``train``/``test`` views
that prune to their partition. Computed once, written once.

``train_register_lookup`` / ``score_latest_lookup``: the same for a model that
looks up its own features; requests bring keys only.

``train_register``: train/test tables -> fit -> score -> metrics (one
aggregate) -> model files -> run rows and a new model version appended to
the run-history tables. Scoring stays a lazy ``transform``.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.functions.names import qualified_name
from tabforge.functions.numeric import round_cents
from tabforge.operators.clean import audit_stamp, preprocess, schema_conform
from tabforge.operators.lookup_model import (SqlFunctionFeature, TableLookup, fit_lookup_model, recipe_text,
                                             request_columns)
from tabforge.operators.metrics import regression_metrics
from tabforge.operators.model import batch_score, save_model, train_gbt
from tabforge.operators.runs import duplicate_versions, latest_version, next_version_row, record_dataset, record_run
from tabforge.operators.split import hash_split
from tabforge.sources.catalog import save_table
from tabforge.sources.models import (example_path, load_model, load_schema, output_schema_path, save_example,
                                     save_schema, schema_path)
from tabforge.spec import FeatureSpec


@dataclass(frozen=True)
class Namespace:
    """Where a job's tables live: ``[catalog.]schema.table``."""

    schema: str = "default"
    catalog: str | None = None
    train: str = "train_set"
    test: str = "test_set"
    splits: str = "split_set"
    runs: str = "runs"
    metrics: str = "run_metrics"
    params: str = "run_params"
    datasets: str = "run_datasets"
    versions: str = "model_versions"

    @property
    def database(self) -> str:
        return qualified_name(*([self.catalog] if self.catalog else []), self.schema)

    def name(self, table: str) -> str:
        return qualified_name(*self.database.split("."), table)


def process_data(spark: SparkSession, raw: DataFrame, spec: FeatureSpec, ns: Namespace = Namespace(),
                 test_size: float = 0.2, seed: int = 42, as_of: _dt.datetime | None = None,
                 buckets: int | None = None) -> tuple[str, str]:
    """Clean, split and save; returns the train and test view names.

    With ``buckets`` the table is also bucketed (and sorted) by the key, so
    later joins on the key with a table bucketed the same way (e.g. the
    feature table) need no shuffle.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {ns.database}")
    clean = preprocess(raw, spec)
    tagged = audit_stamp(hash_split(clean, spec.id_col, test_size, seed, label_col="split"), as_of)
    splits = ns.name(ns.splits)
    save_table(tagged, splits, "overwrite", partition_by=["split"],
               bucket_by=(buckets, spec.id_col) if buckets else None)
    cols = ", ".join(f"`{c}`" for c in tagged.columns if c != "split")
    for view, part in ((ns.train, "train"), (ns.test, "test")):
        spark.sql(f"CREATE OR REPLACE VIEW {ns.name(view)} AS SELECT {cols} FROM {splits} "
                  f"WHERE split = '{part}'")
    return ns.name(ns.train), ns.name(ns.test)


def _save_contract(spark: SparkSession, path: str, inputs: DataFrame, key: str, output) -> None:
    save_schema(spark, inputs.schema, schema_path(path))
    save_schema(spark, output, output_schema_path(path))
    save_example(inputs, key, example_path(path))


def _append(df: DataFrame, name: str) -> None:
    save_table(df, name, "append")


def train_register(spark: SparkSession, spec: FeatureSpec, params: Mapping[str, object],
                   model_root: str, model_name: str, ns: Namespace = Namespace(),
                   tags: Mapping[str, str] | None = None, run_id: str | None = None,
                   ) -> tuple[str, int, DataFrame]:
    """Fit, evaluate, persist, record and register; returns
    ``(run_id, version, metrics_frame)``."""
    run_id = run_id or uuid.uuid4().hex
    train = spark.table(ns.name(ns.train))
    test = spark.table(ns.name(ns.test))
    model = train_gbt(train, spec, params)
    scored = batch_score(model, test, spec, keep=[spec.target])
    metrics = regression_metrics(scored, spec.target).select("mse", "mae", "r2")
    path = save_model(model, f"{model_root.rstrip('/')}/{model_name}/{run_id}")
    # contract and example of the input (features only) and the output's schema lie next to the model
    inputs = train.select(spec.id_col, *spec.num, *spec.cat)
    output = scored.select(spec.id_col, "prediction").schema
    _save_contract(spark, path, inputs, spec.id_col, output)
    _append(record_dataset(run_id, train, ns.name(ns.train), "0", inputs.columns, output), ns.name(ns.datasets))
    version = _register(spark, ns, run_id, model_name, path, params, metrics, tags)
    return run_id, version, spark.table(ns.name(ns.metrics)).where(F.col("run_id") == run_id)


def _register(spark: SparkSession, ns: Namespace, run_id: str, model_name: str, path: str,
              params: Mapping[str, object], metrics: DataFrame, tags: Mapping[str, str] | None) -> int:
    """Append the run's rows and the next version of the model; the version."""
    runs, met, par = record_run(spark, run_id, dict(params), metrics, tags, run_name=model_name)
    _append(runs, ns.name(ns.runs))
    _append(met, ns.name(ns.metrics))
    _append(par, ns.name(ns.params))
    versions_name = ns.name(ns.versions)
    existing = spark.table(versions_name) if spark.catalog.tableExists(versions_name) else None
    row = next_version_row(spark, existing, model_name, run_id, path)
    version = int(row.select("version").first()[0])
    _append(row, versions_name)
    mine = spark.table(versions_name).where((F.col("name") == model_name) & (F.col("version") == version))
    if duplicate_versions(mine).limit(1).collect():
        raise RuntimeError(f"version {version} of {model_name!r} was registered by two runs at a time")
    return version


def _latest_path(spark: SparkSession, ns: Namespace, model_name: str) -> str:
    path = latest_version(spark.table(ns.name(ns.versions)), model_name).select("path").first()
    if path is None:
        raise ValueError(f"no registered versions for {model_name!r}")
    return path[0]


def train_register_lookup(spark: SparkSession, train: DataFrame, test: DataFrame, spec: FeatureSpec,
                          lookups: Sequence[TableLookup], functions: Sequence[SqlFunctionFeature],
                          params: Mapping[str, object], model_root: str, model_name: str, ns: Namespace = Namespace(),
                          exclude: Sequence[str] = (), tags: Mapping[str, str] | None = None,
                          run_id: str | None = None) -> tuple[str, int, DataFrame]:
    """Fit, evaluate, save and register a model that looks up its features.

    ``train`` and ``test`` hold the lookup keys, the label and the columns a
    caller knows; features come from the tables the lookups name. Training,
    evaluation and later scoring assemble rows with the same stages. Returns
    ``(run_id, version, metrics_frame)``.
    """
    run_id = run_id or uuid.uuid4().hex
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {ns.database}")
    model = fit_lookup_model(train, spec, lookups, functions, exclude, params)
    path = save_model(model, f"{model_root.rstrip('/')}/{model_name}/{run_id}")
    wanted = request_columns(train, spec, model)
    scored = model.transform(test.select(*dict.fromkeys([*wanted, spec.target])))
    _save_contract(spark, path, train.select(*wanted), spec.id_col, scored.select(spec.id_col, "prediction").schema)
    metrics = regression_metrics(scored, spec.target).select("mse", "mae", "r2")
    recorded = {**params, **{f"recipe.{i}": line for i, line in enumerate(recipe_text(model))}}
    version = _register(spark, ns, run_id, model_name, path, recorded, metrics, tags)
    return run_id, version, spark.table(ns.name(ns.metrics)).where(F.col("run_id") == run_id)


def score_latest_lookup(spark: SparkSession, model_name: str, df: DataFrame, key: str,
                        ns: Namespace = Namespace(), adjust_cents: bool = False) -> DataFrame:
    """``(key, prediction)`` of every request row by the latest version.

    The request is conformed to the stored input contract (missing column ->
    error, extras such as an old feature value dropped, types cast); the loaded model fetches and computes the
    rest. Unmatched and NULL keys are scored with missing features.
    """
    path = _latest_path(spark, ns, model_name)
    contract = load_schema(spark, schema_path(path))
    scored = load_model(path).transform(schema_conform(df, contract)).select(key, "prediction")
    return scored.withColumn("prediction", round_cents("prediction")) if adjust_cents else scored


def score_latest(spark: SparkSession, spec: FeatureSpec, model_name: str, df: DataFrame,
                 ns: Namespace = Namespace(), adjust_cents: bool = False) -> DataFrame:
    """Resolve the latest version, conform ``df`` to its stored input
    contract (missing column -> error, extras dropped, types cast) and score
    it lazily."""
    path = _latest_path(spark, ns, model_name)
    model = load_model(path)
    contract = load_schema(spark, schema_path(path))
    scored = batch_score(model, schema_conform(df, contract), spec)
    return scored.withColumn("prediction", round_cents("prediction")) if adjust_cents else scored
