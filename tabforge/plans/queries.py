"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory. Each reads the driver tables (or data Spark
derives from them) in full."""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabforge.functions.numeric import age_from_year, round_cents, scale_round
from tabforge.functions.sql_udf import register_age_function
from tabforge.operators import clean, encode, lookup, metrics, model, quality, runs, split
from tabforge.operators.quantile import exact_quantiles
from tabforge.plans import derived as D
from tabforge.session import scratch_path
from tabforge.sources import catalog, files, infer

S = D.ORDERS_SPEC
P = D.PART_SPEC


def _uid(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


# ---------------------------------------------------------------- cleaning
def q_preprocess(spark: SparkSession, sf: str) -> DataFrame:
    return clean.preprocess(D.raw_orders(spark, sf), S)


def q_to_numeric(spark, sf):
    return clean.coerce_numeric(D.raw_orders(spark, sf), ["frontage"]).select("id", "frontage")


def q_impute_mean(spark, sf):
    df = clean.coerce_numeric(D.raw_orders(spark, sf), ["frontage"])
    return clean.impute_mean(df, ["frontage"]).select("id", "frontage")


def q_impute_constant(spark, sf):
    return clean.impute_constant(D.raw_orders(spark, sf), {"veneer_area": 0.0}).select("id", "veneer_area")


def q_impute_median(spark, sf):
    df = clean.coerce_numeric(D.raw_orders(spark, sf), ["frontage"])
    return clean.impute_median(df, ["frontage"]).select("id", "frontage")


def q_fill_category(spark, sf):
    return clean.fill_category(D.raw_orders(spark, sf), S.cat).select("id", *S.cat)


def q_nan_to_null(spark, sf):
    o = D.table(spark, sf, "orders")
    with_nan = o.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "P", F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("price"),
    )
    return clean.nan_to_null_all(with_nan)


def q_select_features(spark, sf):
    return clean.select_features(D.raw_orders(spark, sf), S)


def q_feature_label(spark, sf):
    return clean.feature_label(clean.preprocess(D.raw_orders(spark, sf), S), S)


def q_drop_columns(spark, sf):
    return clean.drop_columns(clean.preprocess(D.raw_orders(spark, sf), S),
                              ["frontage", "veneer_area", "year_built"], strict=True)


def q_cast_columns(spark, sf):
    raw = D.raw_orders(spark, sf)
    return clean.cast_columns(raw, {"frontage": "int", "id": "string", "year_built": "string"},
                              safe=True).select("id", "frontage", "year_built")


def q_audit_stamp(spark, sf):
    return clean.audit_stamp(q_preprocess(spark, sf), as_of=D.as_of_ts())


def q_schema_conform(spark, sf):
    raw = D.raw_orders(spark, sf)
    contract = StructType.fromDDL("id string, year_built bigint, veneer_area double, status string")
    return clean.schema_conform(raw, contract)


# ------------------------------------------------------------ aggregations
def q_agg_mean(spark, sf):
    df = clean.coerce_numeric(D.raw_orders(spark, sf), ["frontage"])
    return df.agg(F.avg("frontage").alias("mean_frontage"), F.avg("veneer_area").alias("mean_veneer_area"))


def q_agg_median(spark, sf):
    df = clean.coerce_numeric(D.raw_orders(spark, sf), ["frontage"])
    m = exact_quantiles(df, {"frontage": [0.5], "year_built": [0.5]})
    return spark.range(1).select(*[F.lit(v[0]).cast("double").alias(f"median_{c}") for c, v in m.items()])


# quantiles asked for in one go, as (label, fraction)
QUANTILES = [("p00", 0.0), ("p01", 0.01), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p99", 0.99), ("p100", 1.0)]


def q_agg_quantiles(spark, sf):
    """Exact quantiles of three columns of the largest table, found together."""
    cols = ["l_extendedprice", "l_quantity", "l_discount"]
    m = exact_quantiles(D.table(spark, sf, "lineitem"), {c: [q for _, q in QUANTILES] for c in cols})
    rows = [(c, label, v) for c in cols for (label, _), v in zip(QUANTILES, m[c])]
    return spark.createDataFrame(rows, "column_name string, quantile string, value double")


def q_null_counts(spark, sf):
    return quality.null_counts(clean.coerce_numeric(D.raw_orders(spark, sf), ["frontage"]))


def q_column_check(spark, sf):
    """Expected against actual columns of the raw orders."""
    raw = D.raw_orders(spark, sf).drop("cust_id")
    return quality.column_report(raw, [*S.contract_columns, "garage_year"])


def q_tree_numbers(spark, sf):
    """Numbers as trees take them: missing ones replaced and marked."""
    df = clean.coerce_numeric(D.raw_orders(spark, sf), ["frontage"])
    return encode.fill_for_trees(df, ["frontage", "veneer_area"], indicator=True).select(
        "id", "frontage", "veneer_area", "frontage_missing", "veneer_area_missing")


def q_conditional_counts(spark, sf):
    df = q_preprocess(spark, sf)
    return quality.conditional_counts(df, {
        "n_priority_none": F.col("priority") == "None",
        "n_veneer_zero": F.col("veneer_area") == 0,
        "n_status_o": F.col("status") == "O",
    })


def q_table_shape(spark, sf):
    return quality.table_shape(q_preprocess(spark, sf))


def q_category_domains(spark, sf):
    return encode.category_domains(q_preprocess(spark, sf), S.cat)


def q_category_domains_large(spark, sf):
    """Domains through the written dictionary (sizes counted)."""
    return encode.fit_dictionary(q_preprocess(spark, sf), S.cat).domains


def q_dictionary_encode(spark, sf):
    df = q_preprocess(spark, sf)
    return encode.dictionary_encode(df, S.cat).select("id", *S.cat)


def q_dictionary_encode_large(spark, sf):
    """The path of large dictionaries: one long-form join for all columns."""
    df = q_preprocess(spark, sf)
    return encode.dictionary_encode(df, S.cat, broadcast_entries=0).select("id", *S.cat)


def q_regression_metrics(spark, sf):
    li = D.table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("prediction")
    )
    m = metrics.regression_metrics(li, "y", "prediction")
    return m.select("n", F.round("mse", 2).alias("mse"), F.round("mae", 6).alias("mae"),
                    F.round("r2", 9).alias("r2"))


def q_dataset_fingerprint(spark, sf):
    o = D.table(spark, sf, "orders")
    return quality.dataset_fingerprint(
        o, ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    )


# ---------------------------------------------------------------- quality
def q_key_violations(spark, sf):
    return quality.key_violations(D.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_param_conflicts(spark, sf):
    return quality.param_conflicts(D.run_params(spark, sf))


def q_snapshot_diff(spark, sf):
    old, new = D.order_snapshots(spark, sf)
    return quality.snapshot_diff(old, new, "id")


def q_snapshot_diff_keyless(spark, sf):
    """Change feed by the co-located join where every tenth row has no key."""
    names = []
    frames = [df.withColumn("id", F.when(F.col("id") % 10 != 0, F.col("id"))) for df in D.order_snapshots(spark, sf)]
    buckets = catalog.bucket_count(*frames)
    for part, df in zip(("old", "new"), frames):
        names.append(catalog.save_table(df, _uid(f"tf_keyless_{part}"), bucket_by=(buckets, "id")))
    return quality.snapshot_diff_join(spark.table(names[0]), spark.table(names[1]), "id")


def q_snapshot_diff_bucketed(spark, sf):
    """Both snapshots saved bucketed by id; the full outer join is co-located."""
    old, new = D.order_snapshots(spark, sf)
    buckets = catalog.bucket_count(old, new)
    names = []
    for part, df in (("old", old), ("new", new)):
        name = _uid(f"tf_snapshot_{part}")
        catalog.save_table(df, name, bucket_by=(buckets, "id"))
        names.append(name)
    return quality.snapshot_diff_join(spark.table(names[0]), spark.table(names[1]), "id")


# ------------------------------------------------------------------ splits
def q_train_test_split(spark, sf):
    return split.hash_split(q_preprocess(spark, sf), "id", D.TEST_SIZE, D.SPLIT_SEED)


def q_split_missing_keys(spark, sf):
    """Exact split by a key that repeats and is missing on a quarter of the rows."""
    return split.hash_split(D.keyless_orders(spark, sf), "cust", D.TEST_SIZE, D.SPLIT_SEED)


def q_bucket_split(spark, sf):
    return split.bucket_split(q_preprocess(spark, sf), "id", 20, D.SPLIT_SEED)


def q_split_check(spark, sf):
    full = q_preprocess(spark, sf)
    train, test = split.train_test(full, "id", D.TEST_SIZE, D.SPLIT_SEED, materialize=True)
    return split.split_check(train, test, full, "id")


# ----------------------------------------------------- joins and features
# Share of rows from which a lookup key is treated as hot (its features are
# broadcast); at most 1 / HOT_KEY_FRACTION keys qualify.
HOT_KEY_FRACTION = 0.01


def q_feature_lookup(spark, sf):
    raw = D.raw_orders(spark, sf).select("id", "cust_id", "target")
    lk = lookup.Lookup(D.customer_features(spark, sf), ("c_acctbal", "c_mktsegment"), "cust_id")
    return lookup.feature_lookup(raw, lk, hot_key_fraction=HOT_KEY_FRACTION)


FEATURE_COLS = (("id", "STRING"), ("frontage", "DOUBLE"), ("veneer_area", "DOUBLE"), ("year_built", "INT"))


def _parts(spark, sf):
    stamped = clean.audit_stamp(q_preprocess(spark, sf), as_of=D.as_of_ts())
    return split.train_test(stamped, "id", D.TEST_SIZE, D.SPLIT_SEED, materialize=True)


def q_feature_union(spark, sf):
    train, test = _parts(spark, sf)
    return lookup.feature_union([train, test], [c for c, _ in FEATURE_COLS])


def q_feature_table(spark, sf):
    train, test = _parts(spark, sf)
    name = _uid("tf_features")
    return catalog.create_feature_table(spark, name, FEATURE_COLS, "id", [train, test])


def _training_set(spark, train: DataFrame, features: DataFrame, hot_key_fraction: float | None = None) -> DataFrame:
    fn = register_age_function(spark, "house_age", as_of_year=D.AS_OF_YEAR)
    base = train.drop("frontage", "veneer_area", "year_built")
    return lookup.training_set(
        base,
        label=S.target,
        lookups=[lookup.Lookup(features, ("frontage", "veneer_area", "year_built"), "id")],
        functions=[lookup.FunctionFeature(fn, "house_age", {"year_built": "year_built"})],
        exclude_columns=["update_timestamp_utc"],
        hot_key_fraction=hot_key_fraction,
    )


def q_training_set(spark, sf):
    train, test = _parts(spark, sf)
    features = lookup.feature_union([train, test], [c for c, _ in FEATURE_COLS])
    return _training_set(spark, train, features, HOT_KEY_FRACTION)


def q_score_lookup(spark, sf):
    train, test = _parts(spark, sf)
    features = lookup.feature_union([train, test], [c for c, _ in FEATURE_COLS])
    fn = register_age_function(spark, "house_age", as_of_year=D.AS_OF_YEAR)
    request = test.drop("frontage", "veneer_area", "year_built", S.target, "update_timestamp_utc")
    return lookup.score_lookup(
        request,
        [lookup.Lookup(features, ("frontage", "veneer_area", "year_built"), "id")],
        [lookup.FunctionFeature(fn, "house_age", {"year_built": "year_built"})],
        hot_key_fraction=HOT_KEY_FRACTION,
    )


def q_training_set_bucketed(spark, sf):
    """Training set from saved tables bucketed by the key: the lookup join of
    the train view and the feature table is shuffle-free (co-located)."""
    from tabforge.jobs import Namespace, process_data

    ns = Namespace(schema=_uid("tf_job"))
    raw = D.raw_orders(spark, sf)
    buckets = catalog.bucket_count(raw)
    train_v, test_v = process_data(spark, raw, S, ns, D.TEST_SIZE, D.SPLIT_SEED, as_of=D.as_of_ts(), buckets=buckets)
    train, test = spark.table(train_v), spark.table(test_v)
    features = catalog.create_feature_table(spark, ns.name("order_features"), FEATURE_COLS, "id",
                                            [train, test], buckets=buckets)
    return _training_set(spark, train, features)


# ------------------------------------------------------- scalar functions
def q_house_age(spark, sf):
    raw = D.raw_orders(spark, sf)
    return raw.select("id", "year_built", age_from_year("year_built", D.AS_OF_YEAR).alias("house_age"))


def q_sql_udf(spark, sf):
    fn = register_age_function(spark, "house_age", as_of_year=D.AS_OF_YEAR)
    raw = D.raw_orders(spark, sf).select("id", "year_built")
    return raw.withColumn("house_age", F.call_function(fn, F.col("year_built")))


def q_adjust_cents(spark, sf):
    o = D.table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("id"),
                    round_cents(F.col("o_totalprice") / 7).alias("adjusted"))


def q_adjust_scaled(spark, sf):
    o = D.table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("id"),
                    scale_round(F.col("o_totalprice") / 7, 1.3).alias("adjusted"))


def linear_part_scorer(pdf: pd.DataFrame) -> pd.Series:
    """A deterministic stand-in for an opaque Python model."""
    return 900.0 + 2.5 * pdf["p_size"].astype("float64") + pdf["p_type"].str.len() * 10.0


def q_map_scorer(spark, sf):
    part = D.table(spark, sf, "part")
    return model.map_scorer(part, "p_partkey", linear_part_scorer, ["p_size", "p_type"])


# ------------------------------------------------------- encoding and ML
def _part_split(spark, sf):
    part = D.table(spark, sf, "part")
    return split.train_test(part, P.id_col, D.TEST_SIZE, D.SPLIT_SEED, materialize=True)


def q_one_hot(spark, sf):
    train, test = _part_split(spark, sf)
    dictionary = encode.fit_dictionary(train, P.cat)
    return encode.one_hot_cells(test, P.id_col, P.cat, dictionary).drop("idx")


def q_one_hot_large(spark, sf):
    """The path of large dictionaries: one shuffled join for all columns."""
    train, test = _part_split(spark, sf)
    dictionary = encode.fit_dictionary(train, P.cat)
    return encode.one_hot_cells(test, P.id_col, P.cat, dictionary, broadcast_entries=0).drop("idx")


def q_assemble(spark, sf):
    """Non-zero slots of each assembled vector, long form (position, value)."""
    train, test = _part_split(spark, sf)
    dictionary = encode.fit_dictionary(train, P.cat)
    return encode.assemble_cells(test, P.id_col, P.cat, P.num, dictionary)


# One tree with one split: its best split and leaf means can be computed by SQL.
ONE_SPLIT = {"learning_rate": 0.1, "n_estimators": 1, "max_depth": 1, "maxBins": 64}
# Four rounds of one split each, fitted in blocks of two rounds.
FOUR_ROUNDS = {**ONE_SPLIT, "learning_rate": 0.5, "n_estimators": 4}


def _rounded(scored: DataFrame) -> DataFrame:
    return scored.withColumn("prediction", F.round("prediction", 6))


def q_train_gbt(spark, sf):
    train, _ = _part_split(spark, sf)
    m = model.train_gbt(train, P, ONE_SPLIT)
    return _rounded(model.batch_score(m, train, P, keep=[P.target]))


def q_boost_blocks(spark, sf):
    """Four boosting rounds in two stored blocks, over all parts."""
    part = D.table(spark, sf, "part")
    m = model.train_gbt(part, P, FOUR_ROUNDS, block_rounds=2)
    return _rounded(model.batch_score(m, part, P, keep=[P.target]))


def q_batch_score(spark, sf):
    train, test = _part_split(spark, sf)
    m = model.train_gbt(train, P, ONE_SPLIT)
    return _rounded(model.batch_score(m, test, P, keep=[P.target]))


def q_score_adjusted(spark, sf):
    train, test = _part_split(spark, sf)
    m = model.train_gbt(train, P, ONE_SPLIT)
    return model.score_adjusted(m, test, P)


def q_model_roundtrip(spark, sf):
    train, test = _part_split(spark, sf)
    m = model.train_gbt(train, P, ONE_SPLIT)
    path = model.save_model(m, scratch_path(spark, "model"))
    return _rounded(model.batch_score(model.load_model(path), test, P))


def q_score_latest(spark, sf):
    train, test = _part_split(spark, sf)
    m = model.train_gbt(train, P, ONE_SPLIT)
    path = model.save_model(m, scratch_path(spark, "model"))
    reg = runs.next_version_row(spark, None, "part_price", "run-0", path)
    from tabforge.sources.models import load_latest

    return _rounded(model.batch_score(load_latest(reg, "part_price"), test, P))


def q_model_metrics(spark, sf):
    train, test = _part_split(spark, sf)
    m = model.train_gbt(train, P, ONE_SPLIT)
    scored = model.batch_score(m, test, P, keep=[P.target])
    return metrics.regression_metrics(scored, P.target).select(
        "n", F.round("mse", 4).alias("mse"), F.round("mae", 6).alias("mae"), F.round("r2", 9).alias("r2"))


PART_FEATURES = (("p_partkey", "STRING"), ("p_size", "INT"), ("p_brand", "STRING"), ("year_built", "INT"))


def _lookup_job(spark, sf):
    """Part features as a feature table, and a registered model that looks them up."""
    from tabforge.jobs import Namespace, train_register_lookup
    from tabforge.operators.lookup_model import TableLookup, age_feature

    ns = Namespace(schema=_uid("tf_job"))
    spark.sql(f"CREATE DATABASE {ns.schema}")
    features = ns.name("part_features")
    catalog.create_feature_table(spark, features, PART_FEATURES, "p_partkey", [D.part_features(spark, sf)])
    train, test = split.train_test(D.part_requests(spark, sf), "p_partkey", D.TEST_SIZE, D.SPLIT_SEED, materialize=True)
    run = train_register_lookup(
        spark, train, test, D.LOOKUP_SPEC,
        [TableLookup(table=features, key="p_partkey", features=["p_size", "p_brand", "year_built"])],
        [age_feature("year_built", as_of_year=D.AS_OF_YEAR)], ONE_SPLIT, scratch_path(spark, "models"), "part_price", ns,
        exclude=["update_timestamp_utc"])
    return ns, test, run


def q_train_register_lookup(spark, sf):
    """Version and test metrics of a registered feature-lookup model."""
    _, _, (_, version, met) = _lookup_job(spark, sf)
    value = F.when(F.col("key") == "mse", F.round("value", 4)).otherwise(F.round("value", 6))
    return met.select("key", value.alias("value"), F.lit(version).cast("int").alias("version"))


def q_score_latest_lookup(spark, sf):
    """Scores by the latest version from keys and the caller's own column only."""
    from tabforge.jobs import score_latest_lookup

    ns, test, _ = _lookup_job(spark, sf)
    request = test.select("p_partkey", "p_mfgr_group")
    return _rounded(score_latest_lookup(spark, "part_price", request, "p_partkey", ns))


# ----------------------------------------------------------- run history
def q_metric_latest(spark, sf):
    return runs.metric_latest(D.run_metrics(spark, sf))


def q_run_maps(spark, sf):
    m = runs.run_maps(D.run_metrics(spark, sf))
    return m.select("run_id", F.size("metrics").cast("bigint").alias("n_keys"), F.explode("metrics"))


def q_run_search(spark, sf):
    r = D.runs(spark, sf)
    # "started more than one hour before" the fixed reference time
    cutoff = (_dt.datetime(2024, 1, 30) - _dt.timedelta(hours=1)).isoformat(sep=" ")
    cond = (
        (F.col("status") == "FINISHED")
        & (F.col("start_time") < F.lit(cutoff).cast("timestamp_ntz"))
        & F.col("run_name").like("%-run-%")
        & (F.try_element_at("metrics", F.lit("purchase")) > 20)
        & ~F.try_element_at("tags", F.lit("k")).eqNullSafe(F.lit("50"))
    )
    out = runs.run_search(r, cond)
    return out.select("run_id", "run_name", "status", "start_time",
                      F.try_element_at("metrics", F.lit("purchase")).alias("m_purchase"))


def q_latest_runs(spark, sf):
    r = D.runs(spark, sf)
    return runs.latest_runs(r, 10, "end_time").select("run_id", "run_name", "end_time")


def q_latest_per_status(spark, sf):
    r = D.runs(spark, sf).select("run_id", "status", "end_time")
    return runs.latest_per_group(r, "status", "end_time")


def q_latest_version(spark, sf):
    v = D.model_versions(spark, sf)
    return runs.latest_version(v).withColumn("next_version", F.col("version") + 1)


def q_record_run(spark, sf):
    li = D.table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("prediction")
    )
    m = metrics.regression_metrics(li, "y", "prediction").select(
        F.round("mse", 2).alias("mse"), F.round("mae", 6).alias("mae"), F.round("r2", 9).alias("r2"))
    _, met, _ = runs.record_run(spark, "eval-lineitem", {"model_type": "formula"}, m,
                                start_time=D.as_of_ts())
    return met.select("run_id", "key", "value", "step")


def q_record_run_full(spark, sf):
    """Tags, params, metrics and the identity of the data of one evaluation run."""
    li = D.table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("prediction"))
    m = metrics.regression_metrics(li, "y", "prediction").select("n")
    run, met, par = runs.record_run(spark, "eval-orders", {"model_type": "formula", "factor": 1500}, m,
                                    {"branch": "main"}, start_time=D.as_of_ts())
    o = D.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    return runs.run_record(run, met, par, runs.record_dataset("eval-orders", o, "orders", "0"))


def q_feature_table_replaced(spark, sf):
    """A feature table loaded again from its own former rows and newer ones."""
    train, test = _parts(spark, sf)
    name = _uid("tf_features")
    first = catalog.create_feature_table(spark, name, FEATURE_COLS, "id", [train])
    raised = test.withColumn("frontage", F.col("frontage") + 1)
    return catalog.create_feature_table(spark, name, FEATURE_COLS, "id", [first, raised])


# ----------------------------------------------------- sources and sinks
def q_csv_scan(spark, sf):
    cust = D.table(spark, sf, "customer")
    path = files.write_csv(cust, scratch_path(spark, "csv"))
    return files.read_csv(spark, path, schema=cust.schema)


def q_na_tokens(spark, sf):
    raw = D.raw_orders(spark, sf).select("id", "frontage", "priority", "status")
    path = files.write_csv(raw, scratch_path(spark, "csv"))
    back = files.read_csv_na(spark, path)
    return back.select(F.col("id").cast("bigint").alias("id"), "frontage", "priority", "status")


def q_csv_types(spark, sf):
    """Types of a raw text file's columns, decided after its missing-value tokens."""
    path = files.write_csv(D.text_orders(spark, sf), scratch_path(spark, "csv"))
    return infer.column_types(files.read_csv(spark, path))


def q_csv_inferred(spark, sf):
    """The same file's rows with the inferred types."""
    path = files.write_csv(D.text_orders(spark, sf), scratch_path(spark, "csv"))
    return infer.read_csv_inferred(spark, path)


def q_table_scan(spark, sf):
    name = _uid("tf_customer")
    catalog.save_table(D.table(spark, sf, "customer"), name)
    return catalog.table_scan(spark, name, ["c_custkey", "c_mktsegment", "c_acctbal"])


def q_table_exists(spark, sf):
    name = _uid("tf_customer")
    catalog.save_table(D.table(spark, sf, "customer"), name)
    t = catalog.table_scan(spark, name)
    return t.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "table_exists", F.lit(catalog.table_exists(spark, name)))


def q_table_properties(spark, sf):
    """Properties of a saved table, set and read back beside its row count."""
    name = _uid("tf_customer")
    catalog.save_table(D.table(spark, sf, "customer"), name)
    catalog.set_table_properties(spark, name, {"feed.enabled": "true", "owner's note": "kept as it's"})
    rows = catalog.table_properties(spark, name).where(F.col("key").isin("feed.enabled", "owner's note"))
    return rows.select("key", "value", spark.table(name).select(F.count(F.lit(1))).scalar().alias("n_rows"))


def q_catalog_tables(spark, sf):
    """The split job's views, read by their three-part names."""
    from tabforge.jobs import Namespace, process_data

    ns = Namespace(schema=_uid("tf_job"), catalog="spark_catalog")
    train, test = process_data(spark, D.raw_orders(spark, sf), S, ns, D.TEST_SIZE, D.SPLIT_SEED, as_of=D.as_of_ts())
    parts = [spark.table(t).groupBy(F.lit(t.split(".")[0] + "." + t.split(".")[-1]).alias("table_name")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("id").cast("bigint")).alias("id_sum")) for t in (train, test)]
    return parts[0].unionByName(parts[1])


def q_save_overwrite(spark, sf):
    name = _uid("tf_orders")
    o = D.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    catalog.save_table(o, name, "overwrite")
    catalog.save_table(o, name, "overwrite")
    return spark.table(name)


def q_save_append(spark, sf):
    name = _uid("tf_orders")
    o = D.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    catalog.save_table(o, name, "overwrite")
    catalog.save_table(o, name, "append")
    return spark.table(name)


# Order-priority codes and their display labels.
PRIORITY_LABELS = [("1-URGENT", "urgent"), ("2-HIGH", "high"), ("3-MEDIUM", "medium"),
                   ("4-NOT SPECIFIED", "unspecified"), ("5-LOW", "low")]


def q_local_rows(spark, sf):
    labels = catalog.local_rows(spark, PRIORITY_LABELS, "o_orderpriority string, label string")
    o = D.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return o.join(F.broadcast(labels), "o_orderpriority", "left").select("o_orderkey", "label")


def q_preview(spark, sf):
    return runs.preview(q_preprocess(spark, sf), 10, ["id"])


def q_process_data(spark, sf):
    """Job 1 end to end: clean, split, stamp, one partitioned write + views."""
    from tabforge.jobs import Namespace, process_data

    ns = Namespace(schema=_uid("tf_job"))
    process_data(spark, D.raw_orders(spark, sf), S, ns, D.TEST_SIZE, D.SPLIT_SEED, as_of=D.as_of_ts())
    return spark.table(ns.name(ns.splits))


# --------------------------------------------------------------- flagship
def q_prepare_training(spark, sf):
    """Dirty orders -> clean -> split tag -> customer lookup -> age."""
    clean_df = clean.preprocess(D.raw_orders(spark, sf), S, keep=["cust_id"])
    tagged = split.hash_split(clean_df, "id", D.TEST_SIZE, D.SPLIT_SEED)
    lk = lookup.Lookup(D.customer_features(spark, sf), ("c_acctbal", "c_mktsegment"), "cust_id")
    out = lookup.feature_lookup(tagged, lk, hot_key_fraction=HOT_KEY_FRACTION)
    return out.withColumn("house_age", age_from_year("year_built", D.AS_OF_YEAR)).select(
        "id", *S.cat, *S.num, "house_age", "c_acctbal", "c_mktsegment", S.target, "split"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "prepare_training": q_prepare_training,
    "preprocess": q_preprocess,
    "to_numeric": q_to_numeric,
    "impute_mean": q_impute_mean,
    "impute_constant": q_impute_constant,
    "impute_median": q_impute_median,
    "fill_category": q_fill_category,
    "nan_to_null": q_nan_to_null,
    "select_features": q_select_features,
    "feature_label": q_feature_label,
    "drop_columns": q_drop_columns,
    "cast_columns": q_cast_columns,
    "audit_stamp": q_audit_stamp,
    "schema_conform": q_schema_conform,
    "agg_mean": q_agg_mean,
    "agg_median": q_agg_median,
    "agg_quantiles": q_agg_quantiles,
    "null_counts": q_null_counts,
    "conditional_counts": q_conditional_counts,
    "column_check": q_column_check,
    "tree_numbers": q_tree_numbers,
    "table_shape": q_table_shape,
    "category_domains": q_category_domains,
    "category_domains_large": q_category_domains_large,
    "dictionary_encode": q_dictionary_encode,
    "dictionary_encode_large": q_dictionary_encode_large,
    "regression_metrics": q_regression_metrics,
    "dataset_fingerprint": q_dataset_fingerprint,
    "key_violations": q_key_violations,
    "param_conflicts": q_param_conflicts,
    "snapshot_diff": q_snapshot_diff,
    "snapshot_diff_bucketed": q_snapshot_diff_bucketed,
    "snapshot_diff_keyless": q_snapshot_diff_keyless,
    "train_test_split": q_train_test_split,
    "split_missing_keys": q_split_missing_keys,
    "bucket_split": q_bucket_split,
    "split_check": q_split_check,
    "feature_lookup": q_feature_lookup,
    "feature_union": q_feature_union,
    "feature_table": q_feature_table,
    "feature_table_replaced": q_feature_table_replaced,
    "training_set": q_training_set,
    "training_set_bucketed": q_training_set_bucketed,
    "score_lookup": q_score_lookup,
    "house_age": q_house_age,
    "sql_udf": q_sql_udf,
    "adjust_cents": q_adjust_cents,
    "adjust_scaled": q_adjust_scaled,
    "map_scorer": q_map_scorer,
    "one_hot": q_one_hot,
    "one_hot_large": q_one_hot_large,
    "assemble": q_assemble,
    "train_gbt": q_train_gbt,
    "boost_blocks": q_boost_blocks,
    "batch_score": q_batch_score,
    "score_adjusted": q_score_adjusted,
    "model_roundtrip": q_model_roundtrip,
    "score_latest": q_score_latest,
    "model_metrics": q_model_metrics,
    "train_register_lookup": q_train_register_lookup,
    "score_latest_lookup": q_score_latest_lookup,
    "metric_latest": q_metric_latest,
    "run_maps": q_run_maps,
    "run_search": q_run_search,
    "latest_runs": q_latest_runs,
    "latest_per_status": q_latest_per_status,
    "latest_version": q_latest_version,
    "record_run": q_record_run,
    "record_run_full": q_record_run_full,
    "csv_scan": q_csv_scan,
    "na_tokens": q_na_tokens,
    "csv_types": q_csv_types,
    "csv_inferred": q_csv_inferred,
    "table_scan": q_table_scan,
    "table_exists": q_table_exists,
    "table_properties": q_table_properties,
    "catalog_tables": q_catalog_tables,
    "save_overwrite": q_save_overwrite,
    "save_append": q_save_append,
    "local_rows": q_local_rows,
    "preview": q_preview,
    "process_data": q_process_data,
}
