"""Cleaning, imputation, projection and casting (all lazy, narrow stages).

Statistics are computed by ONE global aggregate that Spark runs as partial
aggregates per partition plus a single-row final merge, then plugged into the
row stage as a scalar subquery: no cross join, no collect. Two fits are
eager on purpose and bring back bounded scalars only: the exact median
(distributed band narrowing) and ``fit_preprocess`` (fixed statistics for
streams and later batches).
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.numeric import nan_to_null, to_numeric
from tabforge.spec import FeatureSpec


def require_columns(df: DataFrame, cols: Iterable[str]) -> None:
    """Raise ``ValueError`` naming every required column that is absent."""
    have = set(df.columns)
    missing = [c for c in cols if c not in have]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def coerce_numeric(df: DataFrame, cols: Iterable[str], allow_inf: bool = False) -> DataFrame:
    """Apply ``to_numeric`` to each named column in place."""
    cols = list(dict.fromkeys(cols))
    require_columns(df, cols)
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: to_numeric(c, types[c], allow_inf) for c in cols})


def nan_to_null_all(df: DataFrame) -> DataFrame:
    """NaN -> NULL on every float/double column."""
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: nan_to_null(c).cast(df.schema[c].dataType) for c in fl}) if fl else df


def column_stats(df: DataFrame, stats: Mapping[str, Column]) -> Column:
    """One global aggregate of several statistics as a struct scalar subquery."""
    row = df.select(F.struct(*[v.alias(k) for k, v in stats.items()]).alias("s"))
    return row.scalar()


def impute_mean(df: DataFrame, cols: Iterable[str], fit_df: DataFrame | None = None) -> DataFrame:
    """Fill NULLs with the column mean (mean skips NULLs).

    The mean is taken over ``fit_df`` when given (e.g. the train part only,
    to keep test statistics out), else over the whole frame.
    """
    cols = list(cols)
    if not cols:
        return df
    require_columns(df, cols)
    src = df if fit_df is None else fit_df
    s = column_stats(src, {c: F.avg(nan_to_null(F.col(c).cast("double"))) for c in cols})
    # A numeric column with missing values becomes floating, so the mean is
    # never truncated into an integer column.
    return df.withColumns(
        {c: F.coalesce(nan_to_null(F.col(c).cast("double")), s.getField(c)) for c in cols}
    )


def impute_median(df: DataFrame, cols: Iterable[str], approx: bool = False,
                  accuracy: int = 100_000, fit_df: DataFrame | None = None) -> DataFrame:
    """Fill NULLs with the median (exact, interpolated, by default).

    The exact medians of all columns are found together by radix selection
    (see ``quantile.exact_quantiles``); like an estimator's fit, it runs eagerly
    and the values are plugged in as literals. ``approx=True`` stays lazy and uses
    ``percentile_approx`` in one aggregate.
    """
    cols = list(cols)
    if not cols:
        return df
    require_columns(df, cols)
    src = df if fit_df is None else fit_df
    if approx:
        s = column_stats(src, {c: F.percentile_approx(nan_to_null(F.col(c).cast("double")), 0.5, accuracy)
                              .cast("double") for c in cols})
        fills = {c: s.getField(c) for c in cols}
    else:
        from tabforge.operators.quantile import exact_quantiles

        found = exact_quantiles(src, {c: [0.5] for c in cols})
        fills = {c: F.lit(found[c][0]).cast("double") for c in cols}
    return df.withColumns(
        {c: F.coalesce(nan_to_null(F.col(c).cast("double")), fills[c].cast("double")) for c in cols}
    )


def impute_constant(df: DataFrame, values: Mapping[str, float | int | str]) -> DataFrame:
    """Fill NULLs (and NaN in floating columns) with per-column constants."""
    if not values:
        return df
    require_columns(df, values)
    out = {}
    for c, v in values.items():
        dt = df.schema[c].dataType
        col = nan_to_null(c) if isinstance(dt, (T.FloatType, T.DoubleType)) else F.col(c)
        out[c] = F.coalesce(col, F.lit(v).cast(dt))
    return df.withColumns(out)


def fill_category(df: DataFrame, cols: Iterable[str], fill: str = "None") -> DataFrame:
    """Write ``fill`` into missing cells of categorical columns (as text)."""
    cols = list(cols)
    require_columns(df, cols)
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(fill)) for c in cols})


def select_features(df: DataFrame, spec: FeatureSpec, keep: Iterable[str] = ()) -> DataFrame:
    """Contract order ``cat + num + [target] + [id]`` with the key as text.

    ``keep`` names pass-through columns appended after the contract ones.
    """
    keep = list(keep)
    require_columns(df, spec.contract_columns + keep)
    return df.select(
        *spec.cat, *spec.num, spec.target, F.col(spec.id_col).cast("string").alias(spec.id_col), *keep
    )


def feature_label(df: DataFrame, spec: FeatureSpec, with_key: bool = True) -> DataFrame:
    """Model inputs (numeric then categorical) plus the label on one frame."""
    cols = ([spec.id_col] if with_key else []) + spec.features + [spec.target]
    require_columns(df, cols)
    return df.select(*cols)


def drop_columns(df: DataFrame, cols: Iterable[str], strict: bool = False) -> DataFrame:
    """Drop columns; with ``strict`` every named column must exist."""
    cols = list(cols)
    if strict:
        require_columns(df, cols)
    return df.drop(*cols)


def cast_columns(df: DataFrame, types: Mapping[str, str], safe: bool = False) -> DataFrame:
    """Cast columns (``try_cast`` when ``safe`` so dirty input gives NULL)."""
    require_columns(df, types)
    return df.withColumns(
        {c: (F.col(c).try_cast(t) if safe else F.col(c).cast(t)) for c, t in types.items()}
    )


def audit_stamp(df: DataFrame, as_of: _dt.datetime | None = None,
                col: str = "update_timestamp_utc") -> DataFrame:
    """Add the audit timestamp column (UTC wall clock, ``TIMESTAMP_NTZ``).

    ``as_of`` pins the value for repeatable runs; otherwise the query's
    ``current_timestamp()`` converted from the session zone to UTC.
    """
    if as_of is not None:
        ts = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    else:
        ts = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")
    return df.withColumn(col, ts)


def fit_preprocess(df: DataFrame, spec: FeatureSpec) -> dict[str, float | None]:
    """Imputation statistics of ``preprocess`` as plain scalars (one aggregate).

    For applying the same cleaning to later data or to a stream, where the
    statistics must be fixed rather than recomputed per batch.
    """
    numeric = [*spec.extra_numeric, *spec.num]
    require_columns(df, numeric)
    if not spec.mean_fill:
        return {}
    coerced = coerce_numeric(df, numeric)
    row = coerced.agg(*[F.avg(nan_to_null(F.col(c).cast("double"))).alias(c) for c in spec.mean_fill]).first()
    return {c: (None if row[c] is None else float(row[c])) for c in spec.mean_fill}


def preprocess(df: DataFrame, spec: FeatureSpec, keep: Iterable[str] = (),
               stats: dict[str, float | None] | None = None) -> DataFrame:
    """The full cleaning step of the pipeline, lazily.

    coerce numerics -> mean fill -> constant fill -> category fill ->
    contract column order with the key as text. The mean is taken over the
    whole frame before any split, as in the original job, unless fixed
    ``stats`` (from :func:`fit_preprocess`) are given - the form used on
    streams and on later batches.
    """
    numeric = [*spec.extra_numeric, *spec.num]
    require_columns(df, [*numeric, *spec.cat, spec.target, spec.id_col])
    # the target is coerced too (a no-op for numeric input; text from a CSV
    # read becomes a number, unparsable -> NULL)
    out = coerce_numeric(df, [*numeric, spec.target])
    if stats is None:
        out = impute_mean(out, spec.mean_fill)
    else:
        if missing := [c for c in spec.mean_fill if c not in stats]:
            raise ValueError(f"no fitted statistic for {missing}")
        out = out.withColumns({
            c: F.coalesce(nan_to_null(F.col(c).cast("double")), F.lit(stats.get(c)).cast("double"))
            for c in spec.mean_fill
        })
    out = impute_constant(out, spec.constant_fill)
    out = fill_category(out, spec.cat, spec.category_fill)
    return select_features(out, spec, keep)


def schema_of(df: DataFrame) -> str:
    """The schema contract stored next to a model (JSON text)."""
    return df.schema.json()


def schema_conform(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Conform a frame to a recorded schema before scoring.

    Missing column -> error; extra columns -> dropped; types -> cast.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromJson(json.loads(schema))
    require_columns(df, schema.fieldNames())
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
