"""CSV scans and sinks.

Prefer an explicit schema: ``inferSchema`` costs an extra full pass over the
files before the real scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text tokens a pandas CSV reader treats as missing by default.
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
             infer_schema: bool = False, header: bool = True, null_value: str | None = None,
             **options: str) -> DataFrame:
    """CSV scan with a header. With no schema and no inference, every column
    is text (the safest raw landing type)."""
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", True)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path if isinstance(path, str) else list(path))


def normalize_na_tokens(df: DataFrame, tokens: Sequence[str] = PANDAS_NA_TOKENS,
                        cols: Sequence[str] | None = None) -> DataFrame:
    """Text cells equal to any token -> NULL; a token with blanks around it is text."""
    cols = [c for c in (cols or df.columns)
            if isinstance(df.schema[c].dataType, T.StringType)]
    toks = list(tokens)
    return df.withColumns(
        {c: F.when(F.col(c).isin(toks), F.lit(None).cast("string")).otherwise(F.col(c)) for c in cols}
    )


def read_csv_na(spark: SparkSession, path: str | Sequence[str],
                tokens: Sequence[str] = PANDAS_NA_TOKENS, **options: str) -> DataFrame:
    """CSV scan as text with a list of missing-value tokens (``nullValue``
    accepts only one token, so the rest are mapped after the scan).

    The default list includes ``"None"``, like the pandas reader: reading
    back data whose categories were filled with the text ``"None"`` would turn
    them into NULL again, so pass a list without it for such files.
    """
    raw = read_csv(spark, path, schema=None, infer_schema=False, **options)
    return normalize_na_tokens(raw, tokens)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", null_value: str = "",
              header: bool = True) -> str:
    """CSV sink: a directory of part files written in parallel, cells kept as they are."""
    (df.write.mode(mode).option("header", header).option("nullValue", null_value)
       .option("emptyValue", "\"\"").option("ignoreLeadingWhiteSpace", False)
       .option("ignoreTrailingWhiteSpace", False).csv(path))
    return path
