"""Scalar column functions (all JVM-side, codegen friendly)."""

from tabforge.functions.numeric import (
    NUMERIC_PATTERN,
    age_from_year,
    nan_to_null,
    round_cents,
    scale_round,
    to_numeric,
)
from tabforge.functions.names import qualified_name

__all__ = [
    "NUMERIC_PATTERN",
    "age_from_year",
    "nan_to_null",
    "qualified_name",
    "round_cents",
    "scale_round",
    "to_numeric",
]
