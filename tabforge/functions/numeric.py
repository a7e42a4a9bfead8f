"""Numeric coercion, NaN handling, rounding and age columns."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the text shape accepted as a number. Optional sign, digits with
# an optional fraction (or a bare fraction), optional exponent, surrounding
# blanks allowed. Rejects '10d', '10f', '1_0', '0x1F', 'inf', 'nan', '1,000'.
NUMERIC_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

_FLOATING = (T.FloatType, T.DoubleType)
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def nan_to_null(c: Column | str) -> Column:
    """NaN -> NULL for a float/double column (canonical missing is NULL)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nanvl(c, F.lit(None).cast("double"))


# Fixed value: spelled-out infinities accepted when ``allow_inf`` is set.
INF_PATTERN = r"^\s*[+-]?(inf|infinity)\s*$"


def to_numeric(c: str, dtype: T.DataType | None = None, allow_inf: bool = False) -> Column:
    """Coerce a column to a number; anything unparsable becomes NULL.

    Text input is matched against ``NUMERIC_PATTERN`` before ``try_cast`` so
    the accepted shapes are the same on every engine; numeric input keeps its
    type, with NaN mapped to NULL for floating columns. Infinities become NULL
    unless ``allow_inf`` (tree models reject them).
    """
    col = F.col(c)
    if dtype is not None and isinstance(dtype, _NUMERIC):
        if isinstance(dtype, _FLOATING):
            x = nan_to_null(col)
            if not allow_inf:
                x = F.when(F.abs(x) == F.lit(float("inf")), F.lit(None).cast("double")).otherwise(x)
            return x.cast(dtype).alias(c)
        return col.alias(c)
    if isinstance(dtype, T.BooleanType):
        return col.cast("int").cast("double").alias(c)
    text = col.cast("string")
    out = F.when(text.rlike(NUMERIC_PATTERN), F.trim(text).try_cast("double"))
    if not allow_inf:  # digits beyond the range of a double are no number either
        out = F.when(text.rlike(NUMERIC_PATTERN) & (F.abs(F.trim(text).try_cast("double")) < F.lit(float("inf"))),
                     F.trim(text).try_cast("double"))
    else:
        low = F.lower(F.trim(text))
        out = out.when(low.rlike(INF_PATTERN),
                       F.when(low.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
    return out.otherwise(F.lit(None).cast("double")).alias(c)


def round_cents(c: Column | str) -> Column:
    """Round half-to-even to two decimals: ``rint(x * 100) / 100``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.rint(c * F.lit(100.0)) / F.lit(100.0)


def scale_round(c: Column | str, scale_factor: float = 1.3) -> Column:
    """Scale a prediction and round it half-to-even to cents."""
    c = F.col(c) if isinstance(c, str) else c
    return round_cents(c * F.lit(float(scale_factor)))


def age_from_year(year_col: Column | str, as_of: _dt.date | int | Column | None = None) -> Column:
    """Age in whole years: ``year(as_of) - year_col``; NULL in, NULL out.

    ``as_of`` is an explicit date or year so results are repeatable; the
    default is the query's ``current_date()`` (folded once per query).
    """
    y = F.col(year_col) if isinstance(year_col, str) else year_col
    if as_of is None:
        ref = F.year(F.current_date())
    elif isinstance(as_of, Column):
        ref = as_of
    elif isinstance(as_of, int):
        ref = F.lit(as_of)
    else:
        ref = F.lit(as_of.year)
    return (ref - y.cast("int")).cast("int")
