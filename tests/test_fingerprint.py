"""Dataset identity: exact for values, NULLs, names and repeats; free of order and zone."""

import datetime as dt
import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators.quality import dataset_fingerprint, double_text


def mark(df, **k):
    r = dataset_fingerprint(df, **k).first()
    return r.n_rows, r.fingerprint


def frame(spark, rows, schema="a string, b string"):
    return spark.createDataFrame(rows, schema)


def test_values_that_must_differ(spark):
    rows = [[("a|b", "c")], [("a", "b|c")], [(None, "c")], [("\\N", "c")], [("N", "c")], [("", "c")], [("c", None)],
            [("a", "c")], [("a", "c"), ("a", "c")], [("V1:a;1:b=V1:c", None)], [("a;1:b=V1:c", None)], []]
    marks = [mark(frame(spark, r)) for r in rows]
    assert len(set(marks)) == len(rows)
    assert mark(frame(spark, [("a", "c")], "a string, c string")) != mark(frame(spark, [("a", "c")]))  # names
    assert mark(frame(spark, [("a", "c")], "aa string, b string")) != mark(frame(spark, [("a", "c")]))


def test_doubles_are_exact(spark):
    values = [1e-7, 4e-7, 1.0, 1.0 + 2**-52, -1.0, 0.1, 0.1 + 2**-56, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, math.pi,
              float("inf"), float("-inf"), float("nan"), 0.0, 1e300, 2.0**-1074 * 3, 2.0**52 + 1, 8.0, 7.999999999999999]
    texts = [r.t for r in frame(spark, [(v,) for v in values], "x double").select(double_text(F.col("x")).alias("t")).collect()]
    assert len(set(texts)) == len(values)
    for v, t in zip(values, texts):
        if math.isfinite(v) and v:
            m, e = t.split("p")
            assert math.ldexp(int(m), int(e) - 52) == v
    assert mark(frame(spark, [(0.0,)], "x double")) == mark(frame(spark, [(-0.0,)], "x double"))


def test_random_doubles_round_trip(spark):
    r = np.random.default_rng(4)
    v = [x for x in (struct.unpack("<d", r.bytes(8))[0] for _ in range(3000)) if math.isfinite(x) and x]
    v += [2.0**k for k in range(-1074, 1024)]
    rows = frame(spark, [(x,) for x in v], "x double").select("x", double_text(F.col("x")).alias("t")).collect()
    for x, t in rows:
        m, e = t.split("p")
        assert math.ldexp(int(m), int(e) - 52) == x


def test_order_partitions_and_zone_do_not_matter(spark):
    rows = [(i % 7, float(i), None if i % 3 else "x", dt.datetime(2024, 1, 1, 0, i % 60)) for i in range(500)]
    df = frame(spark, rows, "k int, v double, s string, t timestamp")
    want = mark(df)
    assert mark(df.repartition(9).orderBy(F.col("v").desc())) == want
    frozen = spark.createDataFrame(df.rdd, df.schema)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert mark(df) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert mark(frozen) == want and mark(df.limit(499)) != want


def test_other_types_and_labels(spark):
    df = spark.createDataFrame([(True, bytearray(b"\x00|"), [1, None], {"a": 1}, (1, "x"))],
                               "b boolean, y binary, l array<int>, m map<string,int>, s struct<p:int,q:string>")
    one = mark(df)
    assert mark(df.withColumn("l", F.array(F.lit(1), F.lit(2)))) != one
    assert mark(df.withColumn("y", F.lit(b"\x00"))) != one
    r = dataset_fingerprint(df, name="n", version="0").first()
    assert (r.dataset_name, r.dataset_version, r.fingerprint.count("-")) == ("n", "0", 3)
    with pytest.raises(ValueError):
        dataset_fingerprint(df, ["nope"])
