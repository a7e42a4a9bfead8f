"""Feature tables and lookup joins (the training-set assembly).

A lookup is a many-to-one left equi-join on one key. A feature key that
occurs more than once fails the query (it would multiply rows). The join
strategy is left to Catalyst + AQE: the feature side is broadcast only when its measured
size is under ``spark.sql.autoBroadcastJoinThreshold`` (planner statistics, and
again at runtime from real shuffle sizes); otherwise both sides are shuffled
on the key.

``hot_key_fraction`` keeps skew out of that shuffle: keys that hold at least
this share of the rows are found by a sketch, their feature rows (at most
1 / fraction) are broadcast, and their rows, like those without a key, go
through the join with a spread stand-in for the key that matches nothing. No
feature row is copied and no task holds a hot key's rows.
Tables bucketed by the key on both sides join without any shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.sql_udf import apply_function


@dataclass(frozen=True)
class Lookup:
    """Fetch ``feature_names`` from ``table`` by ``lookup_key``."""

    table: DataFrame
    feature_names: tuple[str, ...]
    lookup_key: str
    rename: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class FunctionFeature:
    """Computed feature: SQL function ``udf_name`` bound to input columns."""

    udf_name: str
    output_name: str
    input_bindings: Mapping[str, str]


def hot_keys(df: DataFrame, key: str, fraction: float, max_items_tracked: int = 10_000) -> DataFrame:
    """Keys holding (approximately) at least ``fraction`` of all rows of ``df``.

    One global aggregation: a mergeable frequent-items sketch
    (``approx_top_k``, bounded memory per task, no shuffle of the keys) plus
    the row count. At most ``ceil(1 / fraction)`` keys can qualify, so the
    result has a proven size bound and may be broadcast. The set only steers
    salting, so an estimate near the threshold cannot change any result.
    """
    if not 0.0 < fraction <= 1.0:
        raise ValueError("fraction must be within (0, 1]")
    k = int(math.ceil(1.0 / fraction))
    top = df.agg(
        F.expr(f"approx_top_k(`{key}`, {k}, {int(max(max_items_tracked, 4 * k))})").alias("_top"),
        F.count(F.lit(1)).alias("_n"),
    )
    return (
        top.select(F.explode("_top").alias("_t"), "_n")
        .where(F.col("_t.count") >= F.lit(float(fraction)) * F.col("_n"))
        .select(F.col("_t.item").cast(df.schema[key].dataType).alias(key))
        .where(F.col(key).isNotNull())
    )


def _unique(table: DataFrame, key: str, names: Sequence[str], out_names: Sequence[str]) -> DataFrame:
    """``key`` and a struct ``_f`` of its features; a repeated key raises when its row is read."""
    value = F.struct(*[F.col(c).alias(n) for c, n in zip(names, out_names)])
    one = table.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.first(value).alias("_v"))
    repeated = F.raise_error(F.concat(F.lit("feature table repeats key "), F.col(key).cast("string")))
    return one.select(key, F.when(F.col("_n") > 1, repeated).otherwise(F.col("_v")).alias("_f"))


def feature_lookup(df: DataFrame, lookup: Lookup, how: str = "left",
                   hot_key_fraction: float | None = None) -> DataFrame:
    """Left-join (or inner-join) the named features onto ``df`` by the lookup key.

    Unmatched rows and rows with a NULL key get NULL features (``inner``:
    leave). A looked-up name that already exists on ``df`` is an error (the
    caller must drop it first), and so is a feature key with several rows; feature
    rows with a NULL key are ignored.

    With ``hot_key_fraction`` rows of hot keys and of NULL keys do not meet in
    one task (see the module). ``df`` is read once more for its key column;
    where a row goes is a pure function of the row, so retried tasks agree.
    """
    key = lookup.lookup_key
    if how not in ("left", "inner"):
        raise ValueError(f"lookup join must be left or inner, not {how!r}")
    if key not in df.columns:
        raise ValueError(f"missing required columns: [{key!r}]")
    absent = [c for c in (key, *lookup.feature_names) if c not in lookup.table.columns]
    if absent:
        raise ValueError(f"feature table lacks columns: {absent}")
    out_names = [lookup.rename.get(c, c) for c in lookup.feature_names]
    clash = [c for c in out_names if c in df.columns and c != key]
    if clash:
        raise ValueError(f"looked-up columns already present on input: {clash}")
    right = _unique(lookup.table, key, lookup.feature_names, out_names)
    features = [F.col(f"_f.{n}").alias(n) for n in out_names]
    rest = [c for c in df.columns if c != key]
    if hot_key_fraction is None:
        out = df.join(right, on=key, how=how)
        return out.select(key, *rest, *features)
    hot = hot_keys(df, key, hot_key_fraction)
    of_hot = lookup.table.join(F.broadcast(hot), key, "left_semi")
    # one row per hot key, with its features where it has any
    hot = hot.join(_unique(of_hot, key, lookup.feature_names, out_names).withColumnRenamed("_f", "_hf"), key, "left")
    left = df.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
    # the row's own hash (maps cannot be hashed) spreads what must match nothing
    hashable = [F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    aside = F.col("_hot").isNotNull() | F.col(key).isNull()
    left = left.withColumn("_spread", F.when(aside, F.shiftrightunsigned(F.xxhash64(*hashable), 1) + 1).otherwise(F.lit(0)))
    # always 0, but not as a literal: the join must be on both columns
    cold = right.withColumn("_spread", F.pmod(F.xxhash64(key), F.lit(1)))
    out = left.join(cold, [key, "_spread"], "left").withColumn(
        "_f", F.when(F.col("_hot").isNotNull(), F.col("_hf")).otherwise(F.col("_f")))
    if how == "inner":
        out = out.where(F.col("_f").isNotNull())
    return out.select(key, *rest, *features)


def training_set(
    df: DataFrame,
    label: str,
    lookups: Sequence[Lookup] = (),
    functions: Sequence[FunctionFeature] = (),
    exclude_columns: Iterable[str] = (),
    hot_key_fraction: float | None = None,
) -> DataFrame:
    """Assemble a training set: lookups, then function features, then exclusions."""
    if label not in df.columns:
        raise ValueError(f"missing required columns: [{label!r}]")
    out = df
    for lk in lookups:
        out = feature_lookup(out, lk, hot_key_fraction=hot_key_fraction)
    for fn in functions:
        out = apply_function(out, fn.udf_name, fn.output_name, fn.input_bindings)
    return out.drop(*exclude_columns)


def feature_union(parts: Sequence[DataFrame], cols: Sequence[str]) -> DataFrame:
    """Union-all of the same projection of several frames (by name)."""
    if not parts:
        raise ValueError("no parts to union")
    out = parts[0].select(*cols)
    for p in parts[1:]:
        out = out.unionByName(p.select(*cols))
    return out


def score_lookup(df: DataFrame, lookups: Sequence[Lookup], functions: Sequence[FunctionFeature] = (),
                 hot_key_fraction: float | None = None) -> DataFrame:
    """Score-time assembly: the caller passes the key and the remaining
    columns; looked-up features are fetched with the saved lookup spec."""
    out = df
    for lk in lookups:
        out = feature_lookup(out, lk, hot_key_fraction=hot_key_fraction)
    for fn in functions:
        out = apply_function(out, fn.udf_name, fn.output_name, fn.input_bindings)
    return out
