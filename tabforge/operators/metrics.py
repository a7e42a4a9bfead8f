"""Regression metrics in ONE aggregation (partial per partition, one merge)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """``n, mse, mae, r2`` over rows where both label and prediction are set.

    r2 = 1 - SSE / (var_pop(y) * n); for a constant label it is defined as
    1.0 when every prediction is exact and 0.0 otherwise.
    """
    y = F.col(label).cast("double")
    p = F.col(prediction).cast("double")
    err = y - p
    base = df.where(y.isNotNull() & p.isNotNull())
    agg = base.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(err * err).alias("mse"),
        F.avg(F.abs(err)).alias("mae"),
        F.sum(err * err).alias("_sse"),
        F.var_pop(y).alias("_var"),
    )
    sst = F.col("_var") * F.col("n")
    r2 = (
        F.when(F.col("n") == 0, F.lit(None).cast("double"))
        .when(sst == 0, F.when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
        .otherwise(F.lit(1.0) - F.col("_sse") / sst)
    )
    return agg.select("n", "mse", "mae", r2.alias("r2"))
