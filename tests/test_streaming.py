from tabforge.operators import model, split
from tabforge.plans.derived import PART_SPEC
from tabforge.session import scratch_path
from tabforge.streaming import score_stream
from conftest import SF_SMALL


def test_score_stream_matches_batch(spark):
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    train, test = split.train_test(part, PART_SPEC.id_col)
    m = model.train_gbt(train, PART_SPEC, {"learning_rate": 0.1, "n_estimators": 2, "max_depth": 3})
    src = scratch_path(spark, "stream-src")
    test.repartition(3).write.parquet(src)
    sink = scratch_path(spark, "stream-sink")
    q = score_stream(spark, m, PART_SPEC, src, part.schema, sink, scratch_path(spark, "stream-ckpt"), max_files_per_trigger=1)
    q.awaitTermination(300)
    out = spark.read.parquet(sink)
    batch = {r.p_partkey: r.prediction for r in model.batch_score(m, test, PART_SPEC).collect()}
    streamed = {r.p_partkey: r.prediction for r in out.collect()}
    assert streamed == batch
    assert out.select("batch_id").distinct().count() >= 2


def test_stream_cleans_raw_records_with_fitted_stats(spark):
    from pyspark.sql import functions as F

    from tabforge.operators.clean import fit_preprocess, preprocess
    from tabforge.plans.derived import ORDERS_SPEC, raw_orders

    raw = raw_orders(spark, SF_SMALL)
    stats = fit_preprocess(raw, ORDERS_SPEC)
    clean = preprocess(raw, ORDERS_SPEC)
    # fixed stats reproduce the batch result exactly
    fixed = preprocess(raw, ORDERS_SPEC, stats=stats)
    assert fixed.exceptAll(clean).count() == 0 and clean.exceptAll(fixed).count() == 0
    m = model.train_gbt(clean, ORDERS_SPEC, {"learning_rate": 0.1, "n_estimators": 2, "max_depth": 3})
    src = scratch_path(spark, "raw-src")
    raw.withColumn("id", F.col("id")).repartition(2).write.parquet(src)
    sink = scratch_path(spark, "raw-sink")
    q = score_stream(spark, m, ORDERS_SPEC, src, raw.schema, sink, scratch_path(spark, "stream-ckpt"),
                     clean_spec=ORDERS_SPEC, clean_stats=stats)
    q.awaitTermination(300)
    got = {r.id: r.prediction for r in spark.read.parquet(sink).collect()}
    want = {r.id: r.prediction for r in model.batch_score(m, clean, ORDERS_SPEC).collect()}
    assert got == want
