"""Run history kept as ordinary tables: records, searches, latest values,
model versions.

Tables (long form, append-only):
  runs(run_id, run_name, status, start_time, end_time, tags map<string,string>)
  run_metrics(run_id, key, value double, step bigint, ts timestamp)
  run_params(run_id, key, value string)
  run_datasets(run_id, context, dataset_name, dataset_version, n_rows, fingerprint, input_schema, output_schema)
  model_versions(name, version int, run_id, path, created_at timestamp)

Times are instants; a time given without a zone is UTC.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.operators.clean import require_columns
from tabforge.operators.quality import dataset_fingerprint


def _utc(t: _dt.datetime | None) -> _dt.datetime:
    """An instant: now, or the given time (UTC where it has no zone)."""
    t = t or _dt.datetime.now(_dt.timezone.utc)
    return t if t.tzinfo else t.replace(tzinfo=_dt.timezone.utc)


RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("run_name", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("start_time", T.TimestampType(), True),
    T.StructField("end_time", T.TimestampType(), True),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType()), True),
])
METRICS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("key", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("step", T.LongType(), False),
    T.StructField("ts", T.TimestampType(), True),
])
PARAMS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("key", T.StringType(), False),
    T.StructField("value", T.StringType(), True),
])
VERSIONS_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("version", T.IntegerType(), False),
    T.StructField("run_id", T.StringType(), True),
    T.StructField("path", T.StringType(), True),
    T.StructField("created_at", T.TimestampType(), True),
])


def record_run(
    spark: SparkSession,
    run_id: str,
    params: Mapping[str, object] | None = None,
    metrics: Mapping[str, float] | DataFrame | None = None,
    tags: Mapping[str, str] | None = None,
    run_name: str | None = None,
    status: str = "FINISHED",
    start_time: _dt.datetime | None = None,
    end_time: _dt.datetime | None = None,
    step: int = 0,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows for ``runs``, ``run_metrics`` and ``run_params`` of one run.

    ``metrics`` may be a one-row DataFrame of computed metrics (e.g. the
    output of ``regression_metrics``): it is unpivoted on the executors, so
    the metric values never pass through the driver.
    """
    now = _utc(start_time)
    runs = spark.createDataFrame(
        [(run_id, run_name, status, now, _utc(end_time) if end_time else now, dict(tags or {}))], RUNS_SCHEMA
    )
    if isinstance(metrics, DataFrame):
        num = [f.name for f in metrics.schema.fields
               if isinstance(f.dataType, (T.NumericType,))]
        met = (
            metrics.select(*[F.col(c).cast("double").alias(c) for c in num])
            .unpivot([], num, "key", "value")
            .select(F.lit(run_id).alias("run_id"), "key", "value",
                    F.lit(step).cast("bigint").alias("step"),
                    F.lit(now).cast("timestamp").alias("ts"))
        )
    else:
        met = spark.createDataFrame(
            [(run_id, k, float(v), int(step), now) for k, v in (metrics or {}).items()], METRICS_SCHEMA
        )
    par = spark.createDataFrame(
        [(run_id, k, None if v is None else str(v)) for k, v in (params or {}).items()], PARAMS_SCHEMA
    )
    return runs, met, par


def record_dataset(run_id: str, df: DataFrame, name: str, version: str, input_cols: Sequence[str] | None = None,
                   output_schema: T.StructType | None = None, context: str = "training") -> DataFrame:
    """The row of ``run_datasets`` that ties a run to the data it used.

    The data's identity (row count and fingerprint over all its columns) is
    one aggregate on the executors; schemas are kept as JSON text.
    """
    inputs = df.select(*input_cols) if input_cols else df
    text = lambda s: F.lit(None if s is None else s.json()).cast("string")
    return dataset_fingerprint(df).select(
        F.lit(run_id).alias("run_id"), F.lit(context).alias("context"), F.lit(name).alias("dataset_name"),
        F.lit(version).alias("dataset_version"), "n_rows", "fingerprint", text(inputs.schema).alias("input_schema"),
        text(output_schema).alias("output_schema"))


def run_dataset(spark: SparkSession, datasets: DataFrame, run_id: str, context: str = "training",
                check: bool = True) -> DataFrame:
    """The table a run used, read back as a frame.

    With ``check`` the table's identity is computed again, and a table that
    has changed since the run is refused.
    """
    rows = datasets.where((F.col("run_id") == run_id) & (F.col("context") == context)).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"{len(rows) or 'no'} recorded {context} dataset(s) for run {run_id!r}")
    df = spark.table(rows[0]["dataset_name"])
    if check:
        now = dataset_fingerprint(df).first()
        if (now["n_rows"], now["fingerprint"]) != (rows[0]["n_rows"], rows[0]["fingerprint"]):
            raise ValueError(f"{rows[0]['dataset_name']} is not the data of run {run_id!r} any more")
    return df


def run_record(runs: DataFrame, metrics: DataFrame, params: DataFrame, datasets: DataFrame) -> DataFrame:
    """Everything recorded of runs as ``(run_id, kind, key, value text)`` rows."""
    parts = [
        runs.select("run_id", F.explode("tags").alias("key", "value")).select("run_id", F.lit("tag").alias("kind"), "key", "value"),
        metrics.select("run_id", F.lit("metric").alias("kind"), "key", F.col("value").cast("string").alias("value")),
        params.select("run_id", F.lit("param").alias("kind"), "key", "value"),
        datasets.select("run_id", F.lit("dataset").alias("kind"), F.explode(F.create_map(*[
            x for c in ("context", "dataset_name", "dataset_version", "n_rows", "fingerprint")
            for x in (F.lit(c), F.col(c).cast("string"))])).alias("key", "value")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def metric_latest(metrics: DataFrame, run_col: str = "run_id", key_col: str = "key",
                  value_col: str = "value", step_col: str = "step") -> DataFrame:
    """Last value of every stepped metric per run/key.

    Equal steps are settled by time (column ``ts``, where there is one), then
    by the larger value, so the result does not depend on row order.
    """
    require_columns(metrics, [run_col, key_col, value_col, step_col])
    order = F.struct(step_col, *(["ts"] if "ts" in metrics.columns else []), value_col)
    return metrics.groupBy(run_col, key_col).agg(
        F.max_by(value_col, order).alias("value"), F.max(step_col).alias("step")
    )


def run_maps(metrics: DataFrame | None = None, params: DataFrame | None = None,
             run_col: str = "run_id") -> DataFrame:
    """Per run: ``metrics map<string,double>`` (latest values) and ``params map``.

    Only one entry per (run, key) is ever gathered: metrics are reduced to
    their latest value first, so a map is as large as the run's key set.
    """
    out = None
    if metrics is not None:
        lat = metric_latest(metrics, run_col=run_col)
        out = lat.groupBy(run_col).agg(
            F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("metrics")
        )
    if params is not None:
        dedup = params.groupBy(run_col, "key").agg(F.max("value").alias("value"))
        pm = dedup.groupBy(run_col).agg(
            F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("params")
        )
        out = pm if out is None else out.join(pm, run_col, "full_outer")
    if out is None:
        raise ValueError("give metrics and/or params")
    return out


def run_search(runs: DataFrame, condition: Column | str,
               order_by: Sequence[Column] | None = None) -> DataFrame:
    """Filter run records with an ordinary predicate.

    Map-valued attributes are addressed with ``try_element_at(metrics, 'k')``
    (a missing key is NULL, so the predicate is simply not satisfied).
    """
    cond = F.expr(condition) if isinstance(condition, str) else condition
    out = runs.where(cond)
    return out.orderBy(*order_by) if order_by else out


def latest_runs(runs: DataFrame, k: int = 1, time_col: str = "start_time",
                id_col: str = "run_id") -> DataFrame:
    """Top-k most recent runs (ties broken by id): a bounded top-k, planned as
    a per-partition top-k plus one merge of k rows per partition."""
    return runs.orderBy(F.col(time_col).desc(), F.col(id_col).asc()).limit(int(k))


def latest_per_group(runs: DataFrame, group_col: str, time_col: str = "start_time",
                     id_col: str = "run_id") -> DataFrame:
    """Most recent record per group via ``max_by`` (partial aggregation)."""
    others = [c for c in runs.columns if c != group_col]
    order = F.struct(F.col(time_col), F.col(id_col))
    return runs.groupBy(group_col).agg(
        F.max_by(F.struct(*others), order).alias("_r")
    ).select(group_col, "_r.*")


def latest_version(versions: DataFrame, name: str | None = None) -> DataFrame:
    """Per model name: the highest version with its own path and run (the 'latest' alias)."""
    v = versions if name is None else versions.where(F.col("name") == F.lit(name))
    return v.groupBy("name").agg(F.max(F.struct("version", "path", "run_id")).alias("_v")).select("name", "_v.*")


def duplicate_versions(versions: DataFrame) -> DataFrame:
    """``(name, version, n_rows)`` registered more than once (two writers at a time)."""
    return versions.groupBy("name", "version").agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def next_version_row(spark: SparkSession, versions: DataFrame | None, name: str, run_id: str,
                     path: str, created_at: _dt.datetime | None = None) -> DataFrame:
    """The row registering a new version: ``max(version) + 1`` for the name."""
    current = 0
    if versions is not None:
        v = versions.where(F.col("name") == F.lit(name)).select(F.max("version")).first()[0]
        current = int(v or 0)
    return spark.createDataFrame([(name, current + 1, run_id, path, _utc(created_at))], VERSIONS_SCHEMA)


def preview(df: DataFrame, n: int = 10, order: Sequence[str] | None = None) -> DataFrame:
    """A repeatable bounded preview: ordered limit (top-n, not a bare limit)."""
    cols = list(order or df.columns[:1])
    return df.orderBy(*cols).limit(int(n))
