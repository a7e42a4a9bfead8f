"""Data-quality counts, key rules, snapshot change capture, fingerprints.

Every operator is one aggregation (partial per partition + final merge) or a
shuffle on a key; none emits pairs within a key group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.operators.clean import require_columns

_FLOATING = (T.FloatType, T.DoubleType)


def _is_missing(df: DataFrame, c: str) -> Column:
    col = F.col(c)
    if isinstance(df.schema[c].dataType, _FLOATING):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing (NULL or NaN) count per column, all columns in one pass.

    Long form ``(column_name, n_missing)``; the unpivot runs on the single
    aggregated row.
    """
    cols = list(cols or df.columns)
    require_columns(df, cols)
    wide = df.agg(*[F.count_if(_is_missing(df, c)).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "n_missing")


def column_report(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """``(column_name, expected, present, n_missing)`` of the expected and the actual columns.

    A set of columns is as expected where ``expected`` and ``present`` agree
    on every row. ``n_missing`` counts NULL or NaN cells (NULL for an absent column);
    all counts come from one pass.
    """
    names = list(dict.fromkeys([*expected, *df.columns]))
    wide = df.agg(*[(F.count_if(_is_missing(df, c)) if c in df.columns else F.max(F.lit(None).cast("long"))).alias(f"c{i}")
                    for i, c in enumerate(names)])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(c in expected).alias("expected"), F.lit(c in df.columns).alias("present"),
                 F.col(f"c{i}").alias("n_missing")) for i, c in enumerate(names)])).alias("r")).select("r.*")


def conditional_counts(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """``count_if`` for several named predicates in one pass (one row)."""
    return df.agg(*[F.count_if(p).alias(name) for name, p in predicates.items()])


def table_shape(df: DataFrame) -> DataFrame:
    """``(n_rows, n_columns)`` of a frame as one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint")
    )


def key_violations(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Primary-key rule report: keys that are NULL or occur more than once.

    ``groupBy(key)`` is partially aggregated on the map side, so a hot key
    costs one counter per task, never a buffered group.
    """
    keys = [key] if isinstance(key, str) else list(key)
    require_columns(df, keys)
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where((F.col("n_rows") > 1) | any_null)
        .withColumn("violation", F.when(any_null, F.lit("null_key")).otherwise(F.lit("duplicate_key")))
    )


def param_conflicts(params: DataFrame, run_col: str = "run_id", key_col: str = "key",
                    value_col: str = "value") -> DataFrame:
    """Write-once parameters: ``(run, key)`` logged with more than one value."""
    require_columns(params, [run_col, key_col, value_col])
    # Two plain aggregations instead of a distinct aggregate (which Spark
    # expands row-wise): dedupe (run, key, value) with map-side combine, then
    # count the distinct values per (run, key). NULL values are not counted.
    distinct = params.select(run_col, key_col, value_col).distinct()
    return (
        distinct.groupBy(run_col, key_col)
        .agg(
            F.count(value_col).alias("n_values"),
            F.min(value_col).alias("min_value"),
            F.max(value_col).alias("max_value"),
        )
        .where(F.col("n_values") > 1)
    )


def snapshot_diff(old: DataFrame, new: DataFrame, key: str | Sequence[str],
                  cols: Sequence[str] | None = None, materialize: bool = True,
                  counted: bool = False) -> DataFrame:
    """Row-level change feed between two snapshots of a keyed table.

    Output: key, compared columns, ``_change_type`` in ``insert``, ``delete``,
    ``update_preimage``, ``update_postimage``; unchanged rows are dropped.

    Plan: both snapshots are tagged (-1 old, +1 new) and unioned, then ONE
    aggregation on the full row nets them out (NULL-safe: grouping treats
    NULLs as equal). Only rows whose net count is non-zero - the changed
    ones - are classified by a second, small aggregation on the key. No join
    of the two snapshots, so duplicate keys can never multiply into pairs.

    A row that occurs m times more on one side is reported m times, or once
    with its count in ``_count`` where ``counted``.

    With ``materialize`` the changed rows are checkpointed to the shared
    checkpoint folder (eagerly), so the full netting shuffle runs exactly
    once although both the key classification and the output read it.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if cols is None:
        cols = [c for c in old.columns if c not in keys]
    cols = list(cols)
    require_columns(old, keys + cols)
    require_columns(new, keys + cols)
    allc = keys + cols
    u = old.select(*allc, F.lit(-1).alias("_d")).unionByName(new.select(*allc, F.lit(1).alias("_d")))
    net = u.groupBy(*allc).agg(F.sum("_d").alias("_net")).where(F.col("_net") != 0)
    if materialize:
        from tabforge.session import cut_lineage

        net = cut_lineage(net)
    kk = [f"_key{i}" for i in range(len(keys))]
    kinds = net.groupBy(*[F.col(k).alias(a) for k, a in zip(keys, kk)]).agg(
        F.max((F.col("_net") < 0).cast("int")).alias("_has_old"),
        F.max((F.col("_net") > 0).cast("int")).alias("_has_new"),
    )
    cond = None
    for k, a in zip(keys, kk):
        c = net[k].eqNullSafe(kinds[a])
        cond = c if cond is None else cond & c
    both = (kinds["_has_old"] == 1) & (kinds["_has_new"] == 1)
    change = (
        F.when(both & (net["_net"] < 0), F.lit("update_preimage"))
        .when(both, F.lit("update_postimage"))
        .when(net["_net"] < 0, F.lit("delete"))
        .otherwise(F.lit("insert"))
    )
    joined = net.join(kinds, cond, "inner").select(
        *[net[c] for c in allc], change.alias("_change_type"), F.abs(net["_net"]).alias("_mult")
    )
    if counted:
        return joined.withColumnRenamed("_mult", "_count")
    # repeats in two steps, so that no array is longer than the root of a count
    step = F.lit(4096)
    many = joined.withColumn("_part", F.explode(F.sequence(F.lit(0), F.floor((F.col("_mult") - 1) / step))))
    return many.withColumn("_rep", F.explode(F.sequence(F.lit(1), F.least(step, F.col("_mult") - F.col("_part") * step)))).drop(
        "_rep", "_part", "_mult")


def snapshot_diff_join(old: DataFrame, new: DataFrame, key: str,
                       cols: Sequence[str] | None = None, check_keys: bool = True) -> DataFrame:
    """Change feed by a full outer join on the key (same output as
    :func:`snapshot_diff`).

    For snapshots whose key is unique on each side (check with
    ``key_violations``) and that are stored bucketed by the key with the same
    bucket count: the join then reads both sides co-located, with no shuffle.
    Each key meets at most one row per side, so no pairs can multiply; rows
    without a key (any number) are netted by :func:`snapshot_diff` and united.
    ``check_keys`` verifies that first (a key-only aggregation per side, no
    shuffle on bucketed tables) and refuses duplicated keys, for which the
    netting form :func:`snapshot_diff` is the right tool.
    """
    if cols is None:
        cols = [c for c in old.columns if c != key]
    cols = list(cols)
    require_columns(old, [key, *cols])
    require_columns(new, [key, *cols])
    if check_keys:
        for side, frame in (("old", old), ("new", new)):
            dup = (frame.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
                   .where(F.col("_n") > 1).limit(1).collect())
            if dup:
                raise ValueError(f"{side} snapshot repeats key {dup[0][key]!r}; use snapshot_diff")
    keyless = snapshot_diff(old.where(F.col(key).isNull()), new.where(F.col(key).isNull()), key, cols, materialize=False)
    o = old.where(F.col(key).isNotNull()).select(F.col(key), F.struct(*cols).alias("_o"))
    n = new.where(F.col(key).isNotNull()).select(F.col(key), F.struct(*cols).alias("_n"))
    j = o.join(n, key, "full_outer")
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"_o.{c}").eqNullSafe(F.col(f"_n.{c}"))
    changes = (
        F.when(F.col("_o").isNull(), F.array(F.struct(F.col("_n").alias("r"), F.lit("insert").alias("t"))))
        .when(F.col("_n").isNull(), F.array(F.struct(F.col("_o").alias("r"), F.lit("delete").alias("t"))))
        .when(~same, F.array(F.struct(F.col("_o").alias("r"), F.lit("update_preimage").alias("t")),
                             F.struct(F.col("_n").alias("r"), F.lit("update_postimage").alias("t"))))
    )
    return (
        j.where(F.col("_o").isNull() | F.col("_n").isNull() | ~same)
        .select(key, F.explode(changes).alias("_c"))
        .select(key, *[F.col(f"_c.r.{c}").alias(c) for c in cols], F.col("_c.t").alias("_change_type"))
        .unionByName(keyless)
    )


def double_text(x: Column) -> Column:
    """Exact text of a double, equal for equal values only and the same on every engine.

    ``<mantissa>p<exponent>`` with a 53-bit integer mantissa: scaling by powers
    of two is exact, so no digit depends on how an engine prints numbers.
    -0.0 is 0.
    """
    a = F.abs(x)
    e = F.least(F.floor(F.log2(a)).cast("int"), F.lit(1023))  # the logarithm of the largest doubles rounds up to 1024
    m = a / F.pow(F.lit(2.0), e.cast("double"))  # about [1, 2); the logarithm may be off by one
    e = F.when(m >= 2, e + 1).when(m < 1, e - 1).otherwise(e)
    m = F.when(m >= 2, m / 2).when(m < 1, m * 2).otherwise(m)
    mantissa = (m * F.lit(float(1 << 52))).cast("bigint").cast("string")
    return (F.when(F.isnan(x), F.lit("NaN")).when(a == F.lit(float("inf")), F.when(x > 0, F.lit("inf")).otherwise(F.lit("-inf")))
            .when(x == 0, F.lit("0"))
            .otherwise(F.concat(F.when(x < 0, F.lit("-")).otherwise(F.lit("")), mantissa, F.lit("p"), e.cast("string"))))


def canonical_text(df: DataFrame, c: str) -> Column:
    """Engine-stable text of a value, equal for equal values only (NULL stays NULL)."""
    dt = df.schema[c].dataType
    col = F.col(c)
    if isinstance(dt, _FLOATING):
        return double_text(col.cast("double"))
    if isinstance(dt, T.BooleanType):
        return F.when(col, F.lit("true")).when(~col, F.lit("false"))
    if isinstance(dt, T.BinaryType):
        return F.hex(col)
    if isinstance(dt, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(col)
    if isinstance(dt, T.TimestampType):  # an instant, whatever the session's zone
        return F.unix_micros(col).cast("string")
    return col.cast("string")


def row_text(df: DataFrame, cols: Sequence[str]) -> Column:
    """One text per row that tells all fields apart.

    Every field is its column's name and either ``N`` (NULL) or ``V`` and
    its text, each text behind its length, so no value can look like a
    separator, a NULL or its neighbour's part.
    """
    parts = []
    for c in cols:
        text = canonical_text(df, c)
        value = F.concat(F.lit("V"), F.length(text).cast("string"), F.lit(":"), text)
        parts += [F.lit(f"{len(c)}:{c}="), F.coalesce(value, F.lit("N")), F.lit(";")]
    return F.concat(*parts)


def dataset_fingerprint(df: DataFrame, cols: Sequence[str] | None = None,
                        name: str | None = None, version: str | None = None) -> DataFrame:
    """Order-free identity of a table: row count + sums of all 128 bits of each row's md5.

    Rows are a multiset: their order and partitioning do not matter, their
    number, values, NULLs and column names do. One aggregation of long sums;
    the four exact totals (one per 32 bits) are rendered as text.
    """
    cols = list(cols or df.columns)
    require_columns(df, cols)
    digest = df.select(F.md5(row_text(df, cols)).alias("_h"))
    words = digest.select(*[F.conv(F.substring("_h", 1 + 8 * i, 8), 16, 10).cast("long").alias(f"_w{i}") for i in range(4)])
    # 16-bit halves summed as longs: no overflow below 2^47 rows.
    agg = words.agg(F.count(F.lit(1)).alias("n_rows"), *[
        F.coalesce(F.sum(half), F.lit(0)).alias(f"_s{2 * i + j}") for i in range(4)
        for j, half in enumerate((F.shiftright(f"_w{i}", 16), F.col(f"_w{i}").bitwiseAND(F.lit(0xFFFF))))])
    total = lambda i: (F.col(f"_s{2 * i}").cast("decimal(38,0)") * F.lit(65536).cast("decimal(10,0)")
                       + F.col(f"_s{2 * i + 1}")).cast("decimal(38,0)").cast("string")
    out = agg.select("n_rows", F.concat_ws("-", *[total(i) for i in range(4)]).alias("fingerprint"))
    if name is not None:
        out = out.withColumn("dataset_name", F.lit(name))
    if version is not None:
        out = out.withColumn("dataset_version", F.lit(version))
    return out
