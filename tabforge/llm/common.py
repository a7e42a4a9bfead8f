"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.session import ensure_checkpoint_dir, ship_package

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Shared checkpoint folder and package for Python workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Array of the words of a text, in order (empty for NULL)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A lambda variable holds the value, so the optimizer cannot copy a costly
    expression into each place that uses it.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
