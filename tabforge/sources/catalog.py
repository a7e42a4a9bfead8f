"""Catalog tables: scans, saves, the feature table, existence checks."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tabforge.functions.names import qualified_name
from tabforge.operators.clean import nan_to_null_all
from tabforge.operators.quality import key_violations
from tabforge.session import cut_lineage


def table_scan(spark: SparkSession, name: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Read a catalog table; selected columns prune the scan."""
    df = spark.table(name)
    return df.select(*cols) if cols else df


def local_rows(spark: SparkSession, rows: pd.DataFrame | Sequence[tuple],
               schema: T.StructType | str) -> DataFrame:
    """Driver-held rows -> distributed frame, with an explicit schema and
    NaN normalised to NULL. For small lookup/config data only."""
    if isinstance(rows, pd.DataFrame):
        rows = rows.astype(object).where(pd.notna(rows), None)
        rows = [tuple(r) for r in rows.itertuples(index=False, name=None)]
    return nan_to_null_all(spark.createDataFrame(list(rows), schema))


def save_table(df: DataFrame, name: str, mode: str = "overwrite",
               partition_by: Sequence[str] = (), bucket_by: tuple[int, str] | None = None,
               fmt: str = "parquet") -> str:
    """``saveAsTable`` with overwrite or append.

    Overwriting a table the frame itself reads from is refused by Spark; the
    frame is then checkpointed to the shared checkpoint folder (lineage cut)
    and written from there. ``bucket_by=(n, key)`` lays the table out for
    shuffle-free joins on the key.
    """
    def write(frame: DataFrame) -> None:
        w = frame.write.mode(mode).format(fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
        if bucket_by:
            w = w.bucketBy(int(bucket_by[0]), bucket_by[1]).sortBy(bucket_by[1])
        w.saveAsTable(name)

    try:
        write(df)
    except AnalysisException as e:
        if mode != "overwrite" or "UNSUPPORTED_OVERWRITE" not in str(e):
            raise
        write(cut_lineage(df))
    return name


def bucket_count(*frames: DataFrame, bucket_bytes: int = 256 << 20) -> int:
    """Buckets for tables that will be joined with each other.

    From the largest frame's estimated size, and never fewer than two tasks
    per core; give all tables of a join the same count.
    """
    size = max(int(str(f._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for f in frames)
    cores = frames[0].sparkSession.sparkContext.defaultParallelism
    return max(2 * cores, 16, -(-size // bucket_bytes))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def set_table_properties(spark: SparkSession, name: str, properties: Mapping[str, str]) -> None:
    """Set properties of a catalog table (such as the one that asks for a change feed)."""
    qualified_name(*name.split("."))
    quoted = lambda x: "'" + str(x).replace("\\", "\\\\").replace("'", "\\'") + "'"
    pairs = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def table_properties(spark: SparkSession, name: str) -> DataFrame:
    """``(key, value)`` of a catalog table's properties."""
    qualified_name(*name.split("."))
    return spark.sql(f"SHOW TBLPROPERTIES {name}")


def create_feature_table(
    spark: SparkSession,
    name: str,
    columns: Sequence[tuple[str, str]],
    key: str,
    sources: Sequence[DataFrame],
    buckets: int | None = None,
    check_key: bool = True,
) -> DataFrame:
    """Declare a keyed feature table, fill it from several frames, and put it in place.

    ``columns`` are ``(name, sql_type)`` pairs; the key is declared NOT NULL.
    Rows are written to a staging table of the declared schema (ANSI store
    assignment: lossy casts are errors). The file format does not enforce NOT
    NULL or a primary key, so with ``check_key`` the written key column is
    checked (one aggregation). Only then does the new table take the name: a refused
    load leaves the former table as it was, and a source may be the former table.
    """
    for part in name.split("."):
        qualified_name(part)
    ddl_cols = ", ".join(
        f"{c} {t}{' NOT NULL' if c == key else ''}" for c, t in columns
    )
    bucket = f" CLUSTERED BY ({key}) INTO {int(buckets)} BUCKETS" if buckets else ""
    names = [c for c, _ in columns]
    union = sources[0].select(*names)
    for s in sources[1:]:
        union = union.unionByName(s.select(*names))
    staging = f"{name}__new_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE TABLE {staging} ({ddl_cols}) USING parquet{bucket}")
    try:
        union.write.insertInto(staging)
        if check_key:
            # Checked on the written table: a columnar read of the key only,
            # instead of computing the sources a second time.
            bad = key_violations(spark.table(staging).select(key), key).limit(1).collect()
            if bad:
                raise ValueError(f"key rule violated on {key!r}: {bad[0].asDict()}")
        replace_table(spark, name, staging)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
    return spark.table(name)


def replace_table(spark: SparkSession, name: str, staging: str) -> None:
    """Give the table ``staging`` the name ``name``; the former table is dropped after that.

    Both are renames in the catalog. If the second one fails, the former
    table gets its name back.
    """
    former = f"{name}__old_{uuid.uuid4().hex[:8]}"
    had = table_exists(spark, name)
    if had:
        spark.sql(f"ALTER TABLE {name} RENAME TO {former}")
    try:
        spark.sql(f"ALTER TABLE {staging} RENAME TO {name}")
    except Exception:
        if had:
            spark.sql(f"ALTER TABLE {former} RENAME TO {name}")
        raise
    if had:
        spark.sql(f"DROP TABLE {former}")
