"""Recorded data of a run, model contracts, versions, and replaced feature tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabforge.jobs import Namespace, process_data, train_register
from tabforge.operators import runs
from tabforge.plans.derived import ORDERS_SPEC, raw_orders
from tabforge.session import scratch_path
from tabforge.sources import catalog
from tabforge.sources.models import load_example, load_schema, output_schema_path, schema_path
from conftest import SF_SMALL

COLS = [("Id", "STRING"), ("q", "INT")]


@pytest.fixture(scope="module")
def trained(spark):
    ns = Namespace(schema="tf_lineage_test")
    spark.sql(f"DROP DATABASE IF EXISTS {ns.schema} CASCADE")
    process_data(spark, raw_orders(spark, SF_SMALL), ORDERS_SPEC, ns, as_of=dt.datetime(2025, 1, 1))
    run_id, version, _ = train_register(spark, ORDERS_SPEC, {"n_estimators": 1, "max_depth": 2}, scratch_path(spark, "m"),
                                        "orders_model", ns, tags={"branch": "x"})
    yield ns, run_id, version
    spark.sql(f"DROP DATABASE {ns.schema} CASCADE")


def test_training_data_is_recorded_and_read_back(spark, trained):
    ns, run_id, _ = trained
    datasets = spark.table(ns.name(ns.datasets))
    row = datasets.first()
    assert (row.run_id, row.context, row.dataset_name, row.dataset_version) == (run_id, "training", ns.name(ns.train), "0")
    back = runs.run_dataset(spark, datasets, run_id)
    assert back.count() == row.n_rows == spark.table(ns.name(ns.train)).count()
    with pytest.raises(ValueError, match="no recorded"):
        runs.run_dataset(spark, datasets, "other")
    process_data(spark, raw_orders(spark, SF_SMALL).where("id > 5"), ORDERS_SPEC, ns, as_of=dt.datetime(2025, 1, 1))
    with pytest.raises(ValueError, match="any more"):
        runs.run_dataset(spark, datasets, run_id)
    assert runs.run_dataset(spark, datasets, run_id, check=False).count() > 0


def test_contract_and_example_lie_with_the_model(spark, trained):
    ns, _, _ = trained
    path = spark.table(ns.name(ns.versions)).first().path
    assert load_schema(spark, schema_path(path)).fieldNames() == ["id", *ORDERS_SPEC.num, *ORDERS_SPEC.cat]
    assert load_schema(spark, output_schema_path(path)).simpleString() == "struct<id:string,prediction:double>"
    example = load_example(spark, path).collect()
    assert len(example) == 1 and example[0].id is not None and isinstance(example[0].frontage, float)


def test_versions_keep_their_own_path(spark):
    v = spark.createDataFrame([("m", 2, "r2", "p2", None), ("m", 1, "r1", "zz", None), ("k", 1, "r", "p", None)],
                              runs.VERSIONS_SCHEMA)
    got = {r.name: (r.version, r.path, r.run_id) for r in runs.latest_version(v).collect()}
    assert got == {"m": (2, "p2", "r2"), "k": (1, "p", "r")}
    assert runs.duplicate_versions(v).collect() == []
    assert [tuple(r) for r in runs.duplicate_versions(v.unionByName(v.where("name = 'k'"))).collect()] == [("k", 1, 2)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_are_instants(spark, zone):
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        t = dt.datetime(2025, 1, 1, 12)
        run, met, _ = runs.record_run(spark, "r", {}, {"a": 1.0}, start_time=t)
        want = int(t.replace(tzinfo=dt.timezone.utc).timestamp())
        assert run.select(F.unix_timestamp("start_time")).first()[0] == want
        assert met.select(F.unix_timestamp("ts")).first()[0] == want
        row = runs.next_version_row(spark, None, "m", "r", "p", t)
        assert row.select(F.unix_timestamp("created_at")).first()[0] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_refused_load_keeps_the_former_table(spark):
    good = spark.createDataFrame([("1", 5), ("2", 6)], "Id string, q int")
    t = catalog.create_feature_table(spark, "ft_swap", COLS, "Id", [good])
    assert t.count() == 2
    with pytest.raises(ValueError, match="key rule"):
        catalog.create_feature_table(spark, "ft_swap", COLS, "Id", [good, good])
    with pytest.raises(Exception):
        catalog.create_feature_table(spark, "ft_swap", COLS, "Id", [good.withColumn("q", F.lit("no number"))])
    assert {tuple(r) for r in spark.table("ft_swap").collect()} == {("1", 5), ("2", 6)}
    # the former table may be a source of the new one
    more = spark.createDataFrame([("3", 7)], "Id string, q int")
    new = catalog.create_feature_table(spark, "ft_swap", COLS, "Id", [spark.table("ft_swap"), more])
    assert {r.Id for r in new.collect()} == {"1", "2", "3"}
    names = [r.tableName for r in spark.sql("SHOW TABLES").collect() if "ft_swap" in r.tableName]
    assert names == ["ft_swap"]  # nothing staged is left
    spark.sql("DROP TABLE ft_swap")


def test_failed_swap_gives_the_name_back(spark):
    catalog.create_feature_table(spark, "ft_back", COLS, "Id", [spark.createDataFrame([("1", 5)], "Id string, q int")])
    with pytest.raises(Exception):
        catalog.replace_table(spark, "ft_back", "no_such_staging_table")
    assert spark.table("ft_back").count() == 1
    spark.sql("DROP TABLE ft_back")
