"""Datasets that Spark derives from the driver tables.

The driver tables carry no missing values, so a deterministic "dirty" view of
``orders`` stands in for the raw house-sale file; run history is read from
``events``; two dated snapshots of ``orders`` feed the change feed. Every
derivation keeps all rows of its source table.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.spec import FeatureSpec

# Roles of the dirty orders view (stand-ins for the house data).
ORDERS_SPEC = FeatureSpec(
    num=("frontage", "veneer_area", "year_built"),
    cat=("priority", "status"),
    target="target",
    id_col="id",
    mean_fill=("frontage",),
    constant_fill={"veneer_area": 0.0},
)

# Roles of the part table for the model operators.
PART_SPEC = FeatureSpec(
    num=("p_size",),
    cat=("p_brand", "p_type"),
    target="p_retailprice",
    id_col="p_partkey",
)

# Roles for the model that looks part features up by key.
LOOKUP_SPEC = FeatureSpec(
    num=("p_size", "house_age"),
    cat=("p_brand", "p_mfgr_group"),
    target="p_retailprice",
    id_col="p_partkey",
)

AS_OF_YEAR = 2025
SPLIT_SEED = 42
TEST_SIZE = 0.2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of a driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty view of ``orders``: unparsable numbers, NULLs, missing categories."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id",
        "CASE WHEN o_orderkey % 6 = 0 THEN 'NA' WHEN o_orderkey % 13 = 0 THEN '10d' "
        "ELSE CAST(o_custkey % 97 + 20 AS STRING) END AS frontage",
        "CASE WHEN o_orderkey % 11 = 0 THEN CAST(NULL AS DOUBLE) "
        "ELSE CAST(o_custkey % 500 AS DOUBLE) END AS veneer_area",
        "CASE WHEN o_orderkey % 9 = 0 THEN CAST(NULL AS STRING) ELSE o_orderpriority END AS priority",
        "o_orderstatus AS status",
        "CAST(year(o_orderdate) AS INT) AS year_built",
        "o_custkey AS cust_id",
        "o_totalprice AS target",
    )


def text_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as the text cells of a raw file: every kind of column a reader must tell apart."""
    return table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS id",
        "CASE WHEN o_orderkey % 6 = 0 THEN 'NA' WHEN o_orderkey % 13 = 0 THEN '10d' "
        "ELSE CAST(o_custkey % 97 + 20 AS STRING) END AS frontage",
        "CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE CAST(o_custkey % 500 AS STRING) END AS veneer_area",
        "lpad(CAST(o_custkey % 1000 AS STRING), 4, '0') AS code",
        "CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' WHEN o_orderkey % 2 = 0 THEN 'TRUE' ELSE 'false' END AS flag",
        "CASE WHEN o_orderkey % 5 = 0 THEN ' NA ' WHEN o_orderkey % 7 = 0 THEN 'null' ELSE o_orderpriority END AS note",
        "CASE WHEN o_orderkey % 4 = 0 THEN concat(' ', o_custkey, ' ') ELSE CAST(o_custkey AS STRING) END AS padded",
        "CASE WHEN o_orderkey % 3 = 0 THEN '#N/A' ELSE CAST(o_totalprice AS STRING) END AS price",
        "concat('99999999999999999999', o_orderkey) AS ident",
        "CASE WHEN o_orderkey % 2 = 0 THEN 'NaN' ELSE 'None' END AS nothing",
    )


def keyless_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` under a key that repeats (the customer) and is missing on every fourth row."""
    return table(spark, sf_dir, "orders").selectExpr(
        "CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_custkey % 400 AS STRING) END AS cust", "o_orderkey AS id",
        "o_orderpriority AS priority")


def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed customer feature table (one row per customer)."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cust_id"), "c_acctbal", "c_mktsegment", "c_nationkey"
    )


def part_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed part features. Every tenth part has none (its lookup finds no
    row), every 7th has no size and every 11th no brand."""
    return table(spark, sf_dir, "part").where("p_partkey % 10 <> 3").selectExpr(
        "CAST(p_partkey AS STRING) AS p_partkey",
        "CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size AS INT) END AS p_size",
        "CASE WHEN p_partkey % 11 <> 0 THEN p_brand END AS p_brand",
        "CAST(1950 + (p_partkey % 1000) DIV 20 AS INT) AS year_built",
    )


def part_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a caller knows of a part: its key, a group, and (for training) the price."""
    return table(spark, sf_dir, "part").selectExpr(
        "CAST(p_partkey AS STRING) AS p_partkey", "concat('g', CAST(p_partkey % 3 AS STRING)) AS p_mfgr_group",
        "TIMESTAMP_NTZ '2025-01-01 00:00:00' AS update_timestamp_utc", "p_retailprice")


def _ntz(s: str):
    return F.lit(s).cast("timestamp_ntz")


def order_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two dated states of the order table.

    old = as of 1999-01-01; new = as of 2001-09-01 with a five-year retention.
    An order younger than 90 days at snapshot time still shows status 'O'.
    """
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), "o_orderstatus", "o_totalprice", "o_orderdate"
    )

    def state(asof: str, young: str, keep_from: str | None) -> DataFrame:
        d = o.where(F.col("o_orderdate") < _ntz(asof))
        if keep_from:
            d = d.where(F.col("o_orderdate") >= _ntz(keep_from))
        return d.select(
            "id",
            F.when(F.col("o_orderdate") >= _ntz(young), F.lit("O")).otherwise(F.col("o_orderstatus")).alias("status"),
            F.col("o_totalprice").alias("total"),
        )

    old = state("1999-01-01", "1998-10-03", None)
    new = state("2001-09-01", "2001-06-03", "1996-09-01")
    return old, new


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as stepped metrics: run = user, key = event type, step = event id."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("string").alias("run_id"),
        F.col("event_type").alias("key"),
        F.col("value"),
        F.col("event_id").alias("step"),
        F.col("ts"),
    )


def run_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as logged parameters: ``(run, event type) -> props.k``."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("string").alias("run_id"),
        F.col("event_type").alias("key"),
        F.get_json_object("props", "$.k").alias("value"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per run (user) with the latest metric of each key as a map.

    status = FAILED when the run's last event is an error; name = last event
    type + '-run-' + id; tag ``k`` = props.k of the first event.
    """
    from tabforge.operators.runs import run_maps

    e = table(spark, sf_dir, "events")
    head = e.groupBy(F.col("user_id").cast("string").alias("run_id")).agg(
        F.min("ts").alias("start_time"),
        F.max("ts").alias("end_time"),
        F.max_by("event_type", "event_id").alias("_last_type"),
        F.min_by("props", "event_id").alias("_first_props"),
    )
    maps = run_maps(run_metrics(spark, sf_dir))
    return head.join(maps, "run_id", "left").select(
        "run_id",
        F.concat(F.col("_last_type"), F.lit("-run-"), F.col("run_id")).alias("run_name"),
        F.when(F.col("_last_type") == "error", F.lit("FAILED")).otherwise(F.lit("FINISHED")).alias("status"),
        "start_time",
        "end_time",
        F.create_map(F.lit("k"), F.get_json_object("_first_props", "$.k")).alias("tags"),
        "metrics",
    )


def model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered model versions read from ``events``: one model per event type,
    version = event id, the run that logged it, and its storage path."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("model_"), F.col("event_type")).alias("name"),
        F.col("event_id").alias("version"),
        F.col("user_id").cast("string").alias("run_id"),
        F.concat(F.lit("models/"), F.col("event_type"), F.lit("/v"), F.col("event_id").cast("string")).alias("path"),
        F.col("ts").alias("created_at"),
    )


def as_of_ts() -> _dt.datetime:
    return _dt.datetime(AS_OF_YEAR, 1, 1)
