"""Repeatable train/test splits keyed on a row id.

``hash_split`` gives an exact-size split: rows are ordered by
``md5("<seed>:<key>")`` and the first ``ceil(test_size * n)`` rows form the
test part. The result does not depend on partitioning, and the table is never
sorted or shuffled:

1. the hash of the last test row is found by radix selection on its hex
   digits: a histogram of the first 12 bits (16 for very long tables; key
   column only) locates the bucket that holds that row, the same on the next
   bits while the bucket is not small, and the few hashes left are counted;
2. the main pass is a narrow projection: ``hash < cutoff`` -> test.

Rows without a key are rows like any other: their place comes from a hash of
the whole row, so they count and spread over both parts. Where the last test row falls among
several rows of one key, these (and only these) rows are placed by the hash
of the whole row, and among rows equal in every column by their number in the
frame, so the size is exact. ``keep_groups`` sends such a key's rows to test
together instead (and the rows without a key, having no group, one by one).

``bucket_split`` is the one-pass approximate-fraction variant.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.operators.quality import row_text

_H, _ROW, _NO = "_split_hash", "_split_row", "_split_no"
_LONG = 100_000_000  # beyond so many rows a level has 16 bits (65,536 counters), below 12 (4,096)
_FEW = 10_000  # a bucket of at most so many rows is read by value


def split_hash(key: str, seed: int) -> Column:
    """Hex md5 of ``"<seed>:<key>"``; hex order equals numeric order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def _select(rows: DataFrame, col: str, digits: int, rank: int, n: int | None = None) -> tuple[str, int, int]:
    """Value of the hex text ``col`` at 1-based ``rank``: (value, rows before it, rows with it)."""
    prefix, before = "", 0
    level = 3 if n is not None and n <= _LONG else 4
    while True:
        inside = rows.where(F.col(col).startswith(prefix)) if prefix else rows
        left = digits - len(prefix)
        whole = left <= level or (n is not None and n <= _FEW)
        # few rows: their values; else a histogram of the next digits
        part = F.col(col) if whole else F.substring(col, 1, len(prefix) + level)
        counts = inside.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n")).collect()
        for r in sorted(counts, key=lambda r: r["_p"]):
            if before + r["_n"] >= rank:
                break
            before += r["_n"]
        if whole:
            return r["_p"], before, r["_n"]
        prefix, n = r["_p"], r["_n"]


def _marked(df: DataFrame, key: str, seed: int, missing: bool) -> DataFrame:
    """``df`` with its split hash (of the row where keys are ``missing``), the hash of the whole row, and its number."""
    row = F.md5(F.concat(F.lit(f"{seed}#"), row_text(df, df.columns)))
    out = df.withColumns({_ROW: row, _NO: F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0")})
    return out.withColumn(_H, F.coalesce(split_hash(key, seed), F.col(_ROW)) if missing else split_hash(key, seed))


def _test_rows(df: DataFrame, key: str, test_size: float, seed: int, keep_groups: bool) -> tuple[DataFrame, Column]:
    """:func:`_marked` rows and the condition that holds for exactly the test rows."""
    n, keyed = df.agg(F.count(F.lit(1)), F.count(key)).first()
    # without missing keys no pass reads more than the key column
    marked = _marked(df, key, seed, keyed < n)
    k = math.ceil(test_size * n)
    if k == 0:
        return marked, F.lit(False)
    cut, before, size = _select(marked.select(_H), _H, 32, k, n)
    if before + size == k or (keep_groups and marked.where((F.col(_H) == cut) & F.col(key).isNotNull()).limit(1).count()):
        return marked, F.col(_H) <= cut
    # the last test row lies among rows of one key: whole-row hashes decide there
    tied = marked.where(F.col(_H) == cut)
    row_cut, row_before, row_size = _select(tied.select(_ROW), _ROW, 32, k - before, size)
    among = F.col(_ROW) < row_cut
    if before + row_before + row_size == k:
        among = F.col(_ROW) <= row_cut
    else:  # equal in every column: the first ones of the frame
        same = tied.where(F.col(_ROW) == row_cut)
        number, _, _ = _select(same.select(_NO), _NO, 16, k - before - row_before, row_size)
        among = among | ((F.col(_ROW) == row_cut) & (F.col(_NO) <= number))
    return marked, (F.col(_H) < cut) | ((F.col(_H) == cut) & among)


def hash_split(
    df: DataFrame,
    key: str,
    test_size: float = 0.2,
    seed: int = 42,
    label_col: str = "split",
    keep_groups: bool = False,
) -> DataFrame:
    """Tag every row ``'train'`` or ``'test'`` (exact test size, repeatable).

    The cutoff is found eagerly (a count and two or three passes over the key
    column); tagging is lazy. Among rows that are equal in every column the choice
    follows the frame's row order, so tag a saved frame where such rows may
    straddle the cutoff.
    """
    if not 0.0 <= test_size <= 1.0:
        raise ValueError("test_size must be within [0, 1]")
    if key not in df.columns:
        raise ValueError(f"missing required columns: [{key!r}]")
    marked, test = _test_rows(df, key, test_size, seed, keep_groups)
    return marked.withColumn(label_col, F.when(test, F.lit("test")).otherwise(F.lit("train"))).drop(_H, _ROW, _NO)


def train_test(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42,
               materialize: bool = False) -> tuple[DataFrame, DataFrame]:
    """Two frames from :func:`hash_split`.

    With ``materialize`` the tagged frame is written once as Parquet into the
    shared checkpoint folder (like saving the train and test tables), so both
    parts read it - with the part filter pushed into the scan - instead of
    recomputing the upstream plan.
    """
    tagged = hash_split(df, key, test_size, seed, label_col="_part")
    if materialize:
        from tabforge.session import cut_lineage

        tagged = cut_lineage(tagged)
    train = tagged.where(F.col("_part") == "train").drop("_part")
    test = tagged.where(F.col("_part") == "test").drop("_part")
    return train, test


def bucket_split(
    df: DataFrame,
    key: str,
    test_pct: int = 20,
    seed: int = 42,
    label_col: str = "split",
) -> DataFrame:
    """One-pass split: ``md5`` bucket modulo 100 below ``test_pct`` -> test."""
    h = split_hash(key, seed)
    bucket = F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("long"), F.lit(100))
    return df.withColumn(
        label_col, F.when(bucket < F.lit(int(test_pct)), F.lit("test")).otherwise(F.lit("train"))
    )


def split_check(train: DataFrame, test: DataFrame, full: DataFrame, key: str) -> DataFrame:
    """One-row completeness report of a split.

    sizes add up, key sets are disjoint, and both parts have the same columns.
    The overlap is a set intersection on the key: Spark plans it as a
    distinct (partially aggregated, so a hot key cannot blow up) and a
    left-semi join; no pairs are ever emitted.
    """
    same_cols = sorted(train.columns) == sorted(test.columns) == sorted(full.columns)
    n_train = train.select(F.count(F.lit(1))).scalar()
    n_test = test.select(F.count(F.lit(1))).scalar()
    overlap = (
        train.select(key).intersect(test.select(key)).select(F.count(F.lit(1))).scalar()
    )
    # the report row is the global count of the full frame (one aggregate)
    return full.agg(F.count(F.lit(1)).alias("n_total")).select(
        n_train.alias("n_train"),
        n_test.alias("n_test"),
        "n_total",
        overlap.alias("n_overlap"),
        ((n_train + n_test) == F.col("n_total")).alias("sizes_add_up"),
        F.lit(same_cols).alias("same_columns"),
    )
