"""Catalog functions written in SQL (inlined by the optimizer).

A SQL function body is a Catalyst expression, so it stays inside whole-stage
codegen; a Python UDF would be opaque and evaluated row by row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def register_age_function(spark: SparkSession, name: str = "house_age", as_of_year: int | None = None,
                          temporary: bool = True) -> str:
    """Define ``name(year_built INT) RETURNS INT`` = reference year - year_built.

    ``as_of_year`` pins the reference year; by default it is the year of the
    query's ``current_date()``.
    """
    ref = str(int(as_of_year)) if as_of_year is not None else "year(current_date())"
    kind = "TEMPORARY FUNCTION" if temporary else "FUNCTION"
    spark.sql(
        f"CREATE OR REPLACE {kind} {name}(year_built INT) RETURNS INT "
        f"RETURN CAST({ref} - year_built AS INT)"
    )
    return name


def apply_function(df: DataFrame, udf_name: str, output_name: str,
                   input_bindings: Mapping[str, str]) -> DataFrame:
    """Bind function arguments to columns and add the result as a column.

    ``input_bindings`` maps the function's parameter names, in declaration
    order, to input columns.
    """
    missing = [c for c in input_bindings.values() if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    args: list[Column] = [F.col(c) for c in input_bindings.values()]
    return df.withColumn(output_name, F.call_function(udf_name, *args))
