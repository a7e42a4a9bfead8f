import contextlib
import hashlib
import io
import math

from pyspark.sql import functions as F

from tabforge.operators import split
from conftest import SF_SMALL


def _brute(ids, seed=42, test_size=0.2):
    order = sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), str(i)))
    k = math.ceil(test_size * len(ids))
    return set(order[:k])


def test_exact_size_matches_brute_force(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(
        F.col("o_orderkey").cast("string").alias("id"))
    tagged = split.hash_split(df, "id")
    got = {r.id for r in tagged.where("split = 'test'").collect()}
    ids = [r.id for r in df.collect()]
    assert got == _brute(ids)


def test_stable_under_repartitioning(spark):
    df = spark.range(0, 5000).select(F.col("id").cast("string").alias("id"))
    a = {r.id for r in split.hash_split(df, "id").where("split='test'").collect()}
    b = {r.id for r in split.hash_split(df.repartition(13), "id").where("split='test'").collect()}
    assert a == b and len(a) == 1000


def test_small_bucket_digits_and_edges(spark):
    df = spark.range(0, 997).select(F.col("id").cast("string").alias("id"))
    ids = [str(i) for i in range(997)]
    got = {r.id for r in split.hash_split(df, "id", 0.3, 7)
           .where("split='test'").collect()}
    assert got == _brute(ids, 7, 0.3)
    assert split.hash_split(df, "id", 0.0).where("split='test'").count() == 0
    assert split.hash_split(df, "id", 1.0).where("split='train'").count() == 0
    empty = df.limit(0)
    assert split.hash_split(empty, "id").count() == 0


def test_float_size_rule_like_sklearn(spark):
    # ceil(0.2 * 15) in floating point is 4, as in the original splitter.
    df = spark.range(15).select(F.col("id").cast("string").alias("id"))
    assert split.hash_split(df, "id").where("split='test'").count() == math.ceil(0.2 * 15)


def test_train_test_and_check(spark):
    df = spark.range(0, 1000).select(F.col("id").cast("string").alias("id"), (F.col("id") * 2).alias("v"))
    train, test = split.train_test(df, "id")
    r = split.split_check(train, test, df, "id").first()
    assert (r.n_train, r.n_test, r.n_total, r.n_overlap) == (800, 200, 1000, 0)
    assert r.sizes_add_up and r.same_columns


def test_bucket_split_is_one_pass(spark):
    df = spark.range(0, 2000).select(F.col("id").cast("string").alias("id"))
    out = split.bucket_split(df, "id")
    n = out.where("split='test'").count()
    assert 300 < n < 500
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    assert "Exchange" not in buf.getvalue()


def test_duplicated_hot_key_stays_together(spark):
    # key "hot" holds a third of the rows; every key's rows share one side
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id"))
    out = split.hash_split(df, "k", 0.2, keep_groups=True)
    sides = out.groupBy("k").agg(F.countDistinct("split").alias("n")).where("n > 1").count()
    assert sides == 0
    assert out.count() == 3000
    n_test = out.where("split = 'test'").count()
    assert n_test >= 600


def test_null_keys_are_rows_like_any_other(spark):
    df = spark.range(0, 100).select(F.when(F.col("id") < 50, F.col("id").cast("string")).alias("k"), "id")
    out = split.hash_split(df, "k", 0.2)
    test = out.where("split = 'test'")
    assert test.count() == 20 and 0 < test.where("k IS NULL").count() < 20
    again = split.hash_split(df.repartition(7), "k", 0.2).where("split = 'test'")
    assert {r.id for r in again.collect()} == {r.id for r in test.collect()}


def test_repeated_keys_give_the_exact_size(spark):
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id")
    for size in (0.05, 0.2, 0.5, 0.9):
        out = split.hash_split(df, "k", size)
        assert out.where("split = 'test'").count() == math.ceil(size * 3000)
        # at most one key has rows on both sides
        assert out.groupBy("k").agg(F.countDistinct("split").alias("n")).where("n > 1").count() <= 1


def test_rows_equal_in_every_column(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(0, 1000).select(F.lit("same").alias("k"), F.lit(None).cast("int").alias("v")).repartition(5).write.parquet(path)
    df = spark.read.parquet(path)
    for size in (0.001, 0.25, 0.999):
        assert split.hash_split(df, "k", size).where("split = 'test'").count() == math.ceil(size * 1000)
    nulls = df.withColumn("k", F.lit(None).cast("string"))
    assert split.hash_split(nulls, "k", 0.3).where("split = 'test'").count() == 300


def test_brute_force_with_null_and_repeated_keys(spark):
    from tabforge.operators.quality import row_text

    df = spark.range(0, 600).select(
        F.when(F.col("id") % 4 != 0, (F.col("id") % 9).cast("string")).alias("k"), "id")
    rows = df.select("id", "k", F.md5(F.concat(F.lit("5#"), row_text(df, df.columns))).alias("r")).collect()
    order = sorted((hashlib.md5(f"5:{r.k}".encode()).hexdigest() if r.k is not None else r.r, r.r, r.id) for r in rows)
    for size in (0.1, 0.33, 0.77):
        got = {r.id for r in split.hash_split(df, "k", size, 5).where("split = 'test'").collect()}
        assert got == {x[2] for x in order[:math.ceil(size * 600)]}


def test_large_buckets_take_more_levels(spark, monkeypatch):
    monkeypatch.setattr(split, "_FEW", 3)
    df = spark.range(0, 2000).select(F.col("id").cast("string").alias("id"))
    got = {r.id for r in split.hash_split(df, "id").where("split = 'test'").collect()}
    assert got == _brute([str(i) for i in range(2000)])
