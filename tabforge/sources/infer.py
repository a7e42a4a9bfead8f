"""Column types of text tables, decided over all cells as a pandas CSV reader does.

Spark's own CSV inference runs before missing-value tokens are known, so one
``NA`` keeps a numeric column textual. Here tokens become NULL first, then ONE
aggregate counts the shapes of every column's cells and the narrowest type
that holds them all is taken:

- every cell an integer: ``bigint``; with missing cells ``double``; beyond 64 signed
  bits ``decimal(20,0)`` if none is negative or missing and all fit 64 unsigned bits, else text;
- every cell a number (or an unpadded infinity): ``double``; digits beyond a double's
  range, or an integer beyond 64 bits among fractions, keep the column textual;
- every cell true or false in any case, unpadded: ``boolean`` (missing cells NULL);
- no cell at all: ``double``;
- anything else, such as a token with blanks around it: ``string``, unchanged.

Numbers may have white space around them, as in pandas.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.numeric import NUMERIC_PATTERN
from tabforge.operators.clean import require_columns
from tabforge.sources.files import PANDAS_NA_TOKENS, normalize_na_tokens, read_csv

INT_PATTERN = r"^\s*[+-]?\d+\s*$"
INF_PATTERN = r"^(?i)[+-]?(inf|infinity)$"
BOOL_PATTERN = r"^(?i)(true|false)$"
MOST_UNSIGNED = "18446744073709551615"


def _shapes(c: str) -> dict[str, Column]:
    """What is counted of one text column."""
    x = F.col(c)
    integer = x.rlike(INT_PATTERN)
    wide = F.trim(x).try_cast("decimal(38,0)")
    return {
        "cells": x.isNotNull(), "missing": x.isNull(), "ints": integer,
        "numbers": x.rlike(NUMERIC_PATTERN) & (F.abs(x.try_cast("double")) < F.lit(float("inf"))),
        "infinities": x.rlike(INF_PATTERN), "bools": x.rlike(BOOL_PATTERN),
        "over": integer & x.try_cast("bigint").isNull(),
        "far_over": integer & F.coalesce(F.abs(wide) > F.lit(MOST_UNSIGNED).cast("decimal(38,0)"), F.lit(True)),
        "negative": integer & x.contains("-"),
    }


def _type(s: Column) -> Column:
    """The decision from the counts (a struct per column)."""
    n = lambda name: s.getField(name)
    return (F.when(n("cells") == 0, "double")
            .when((n("ints") == n("cells")) & (n("over") == 0), F.when(n("missing") == 0, "bigint").otherwise("double"))
            .when(n("ints") == n("cells"), F.when((n("far_over") + n("negative") + n("missing")) == 0, "decimal(20,0)")
                  .otherwise("string"))
            .when((n("numbers") + n("infinities") == n("cells")) & (n("far_over") == 0), "double")
            .when(n("bools") == n("cells"), "boolean").otherwise("string"))


def column_types(text: DataFrame, tokens: Sequence[str] = PANDAS_NA_TOKENS,
                 cols: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, type, n_rows, n_missing)`` of the text columns, in column order, from one pass."""
    cols = list(cols or [f.name for f in text.schema.fields if isinstance(f.dataType, T.StringType)])
    require_columns(text, cols)
    clean = normalize_na_tokens(text, tokens, cols)
    names = list(_shapes(cols[0])) if cols else []
    wide = clean.agg(F.count(F.lit(1)).alias("n"), *[
        F.struct(*[F.count_if(v).alias(k) for k, v in _shapes(c).items()]).alias(f"s{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"s{i}").alias("s")) for i, c in enumerate(cols)])
    if not names:
        return text.sparkSession.createDataFrame([], "column_name string, type string, n_rows long, n_missing long")
    return wide.select("n", F.explode(rows).alias("r")).select(
        "r.column_name", _type(F.col("r.s")).alias("type"), F.col("n").alias("n_rows"), F.col("r.s.missing").alias("n_missing"))


def infer_types(text: DataFrame, tokens: Sequence[str] = PANDAS_NA_TOKENS,
                cols: Sequence[str] | None = None) -> dict[str, str]:
    """Type per text column (one row per column reaches the driver)."""
    return {r["column_name"]: r["type"] for r in column_types(text, tokens, cols).collect()}


def apply_types(text: DataFrame, types: Mapping[str, str], tokens: Sequence[str] = PANDAS_NA_TOKENS) -> DataFrame:
    """Missing tokens as NULL, cells as values of the given types; other columns unchanged."""
    require_columns(text, types)
    out = {}
    for c, t in types.items():
        x = F.col(c)
        if t == "double":
            out[c] = F.when(x.rlike(INF_PATTERN), F.when(x.startswith("-"), F.lit(float("-inf"))).otherwise(
                F.lit(float("inf")))).otherwise(F.when(x.rlike(NUMERIC_PATTERN), x.try_cast("double")))
        elif t == "boolean":
            out[c] = F.lower(x) == F.lit("true")
        elif t != "string":
            out[c] = F.trim(x).try_cast(t)
    return normalize_na_tokens(text, tokens, list(types)).withColumns(out)


def read_csv_inferred(spark: SparkSession, path: str | Sequence[str], tokens: Sequence[str] = PANDAS_NA_TOKENS,
                      types: Mapping[str, str] | None = None, **options: str) -> DataFrame:
    """CSV scan with missing-value tokens and inferred (or given) column types.

    The files are read as text once for the counts and once for the rows;
    pass ``types`` from an earlier ``infer_types`` to skip the first pass.
    """
    text = read_csv(spark, path, schema=None, infer_schema=False, **options)
    return apply_types(text, types if types is not None else infer_types(text, tokens), tokens)
