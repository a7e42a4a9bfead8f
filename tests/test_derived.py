"""Derived datasets keep every row of the driver tables they come from."""

from pyspark.sql import functions as F

from tabforge.plans import derived as D
from conftest import SF_MID


def test_dirty_view_keeps_all_orders(spark):
    orders = D.table(spark, SF_MID, "orders")
    raw = D.raw_orders(spark, SF_MID)
    assert raw.count() == orders.count()
    assert raw.select("id").distinct().count() == orders.count()


def test_snapshots_cover_every_order(spark):
    old, new = D.order_snapshots(spark, SF_MID)
    covered = old.select("id").union(new.select("id")).distinct().count()
    assert covered == D.table(spark, SF_MID, "orders").count()


def test_run_tables_cover_every_event(spark):
    events = D.table(spark, SF_MID, "events")
    assert D.run_metrics(spark, SF_MID).count() == events.count()
    assert D.run_params(spark, SF_MID).count() == events.count()
    assert D.model_versions(spark, SF_MID).count() == events.count()
    n_users = events.select("user_id").distinct().count()
    runs = D.runs(spark, SF_MID)
    assert runs.count() == n_users
    assert runs.where(F.col("metrics").isNull()).count() == 0
