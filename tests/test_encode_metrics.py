import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabforge.operators import encode, metrics


def test_one_hot_unseen_and_null_are_zeros(spark):
    fit = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, "c")], "id int, c string")
    m = encode.fit_one_hot(fit, ["c"])
    new = spark.createDataFrame([(1, "a"), (2, "zzz"), (3, None)], "id int, c string")
    out = m.transform(new).select("id", vector_to_array("c__ohe").alias("v")).orderBy("id").collect()
    assert [list(r.v) for r in out] == [[1.0, 0.0, 0.0], [0.0, 0.0, 0.0], [0.0, 0.0, 0.0]]
    long = encode.one_hot_long(new, "id", ["c"], m).collect()
    assert [(r.id, r.feature, r.category, r.value) for r in long] == [(1, "c", "a", 1.0)]


def test_category_domains_alphabetical(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), ("b", None)], "p string, q string")
    got = {(r.feature, r.category, r.idx) for r in encode.category_domains(df, ["p", "q"]).collect()}
    assert got == {("p", "a", 0), ("p", "b", 1), ("q", "x", 0), ("q", "y", 1)}


def test_dictionary_encode(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c")], "id int, c string")
    out = encode.dictionary_encode(df, ["c"]).orderBy("id").collect()
    assert [r.c for r in out] == [1, 0, 2]


def test_assembler_order_and_width(spark):
    from pyspark.ml import Pipeline

    df = spark.createDataFrame([(1, "a", 5.0), (2, "b", 6.0)], "id int, c string, n double")
    m = Pipeline(stages=encode.one_hot_stages(["c"]) + [encode.assembler(["c"], ["n"])]).fit(df)
    rows = m.transform(df).select(vector_to_array("features").alias("f")).orderBy(F.col("f")[2]).collect()
    assert [list(r.f) for r in rows] == [[1.0, 0.0, 5.0], [0.0, 1.0, 6.0]]


def test_fill_for_trees(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "x double")
    out = encode.fill_for_trees(df, ["x"], indicator=True).collect()
    assert [r.x_missing for r in out] == [0, 1, 1]
    assert out[1].x == encode.MISSING_SENTINEL


def test_regression_metrics_against_numpy(spark):
    rng = np.random.default_rng(0)
    y = rng.normal(100, 20, 500)
    p = y + rng.normal(0, 5, 500)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, prediction double")
    r = metrics.regression_metrics(df, "y").first()
    mse = float(np.mean((y - p) ** 2))
    assert r.n == 500
    assert r.mse == pytest.approx(mse, rel=1e-12)
    assert r.mae == pytest.approx(float(np.mean(np.abs(y - p))), rel=1e-12)
    assert r.r2 == pytest.approx(1 - mse * 500 / float(np.sum((y - y.mean()) ** 2)), rel=1e-12)


def test_regression_metrics_constant_label_and_nulls(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0), (None, 3.0)], "y double, prediction double")
    assert metrics.regression_metrics(df, "y").first().r2 == 1.0
    df2 = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "y double, prediction double")
    r = metrics.regression_metrics(df2, "y").first()
    assert (r.r2, r.n) == (0.0, 2)


def _wide_frame(spark):
    return spark.range(0, 6000).select(
        "id",
        (F.col("id") % 2500).cast("string").alias("a"),
        F.concat(F.lit("v"), (F.col("id") % 1700).cast("string")).alias("b"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).when(F.col("id") % 2 == 0, "hot").otherwise(
            (F.col("id") % 7).cast("string")).alias("c"),
    ).repartition(6)


def test_category_domains_are_alphabetical_at_any_partitioning(spark):
    df = _wide_frame(spark)
    values = {"a": {str(i) for i in range(2500)}, "b": {f"v{i}" for i in range(1700)}, "c": {"hot", *map(str, range(7))}}
    want = {(c, v, i) for c, vs in values.items() for i, v in enumerate(sorted(vs))}
    for n in ("7", "4"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        assert {tuple(r) for r in encode.category_domains(df, ["a", "b", "c"]).collect()} == want
    d = encode.fit_dictionary(df, ["c", "a"])
    assert d.sizes == {"c": 8, "a": 2500} and d.entries == 2508


@pytest.mark.parametrize("entries", [0, 100_000])
def test_dictionary_encode_paths(spark, entries):
    df = _wide_frame(spark)
    fit = df.where("id < 3000").unionByName(df.where("id = 1").withColumn("a", F.lit("zz")))
    d = encode.fit_dictionary(fit, ["a", "b", "c"])
    order = {c: sorted({r[c] for r in fit.collect()} - {None}) for c in ("a", "b", "c")}
    got = {r.id: (r.a, r.b, r.c) for r in encode.dictionary_encode(df, ["a", "b", "c"], d, broadcast_entries=entries).collect()}
    at = {c: {v: i for i, v in enumerate(vs)} for c, vs in order.items()}
    assert got == {r.id: tuple(at[c].get(r[c], len(at[c])) for c in ("a", "b", "c")) for r in df.collect()}
    out = encode.dictionary_encode(df, ["c"], broadcast_entries=entries)
    assert out.columns == df.columns and dict(out.dtypes)["c"] == "int"


def _exchanges(df) -> tuple[int, str]:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    text = buf.getvalue()
    return text.count("Exchange hashpartitioning"), text


def test_one_shuffle_of_cells_for_any_number_of_columns(spark):
    df = _wide_frame(spark)
    d = encode.fit_dictionary(df, ["a", "b", "c"])
    counts = {n: _exchanges(encode.dictionary_encode(df, ["a", "b", "c"][:n], d, broadcast_entries=0, hot_share=None))[0]
              for n in (1, 2, 3)}
    assert len(set(counts.values())) == 1
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n, text = _exchanges(encode.one_hot_cells(df, "id", ["a", "b", "c"], d, broadcast_entries=0, hot_share=None))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert n == 2  # the cells and the dictionary, whatever the number of columns
    assert all("_cell" in x for x in text.splitlines() if "Exchange hashpartitioning" in x)
    assert _exchanges(encode.one_hot_cells(df, "id", ["a", "b", "c"], d))[0] == 0  # broadcast: no shuffle


@pytest.mark.parametrize("entries", [0, 100_000])
def test_one_hot_cells_match_vector_form(spark, entries):
    fit = spark.createDataFrame([(1, "b", "x"), (2, "a", "y"), (3, "b", None), (4, "c", "x")], "id int, c string, d string")
    new = spark.createDataFrame([(1, "a", "y"), (2, "zzz", "x"), (3, None, None), (4, "c", "x"), (4, "c", "x")],
                                "id int, c string, d string")
    a = sorted(tuple(r) for r in encode.one_hot_long(new, "id", ["c", "d"], encode.fit_one_hot(fit, ["c", "d"])).collect())
    d = encode.fit_dictionary(fit, ["c", "d"])
    cells = encode.one_hot_cells(new, "id", ["c", "d"], d, broadcast_entries=entries)
    assert sorted(tuple(r) for r in cells.drop("idx").collect()) == a
    assert len(a) == 7


def test_assembled_cells_are_the_vector(spark):
    from pyspark.ml import Pipeline

    fit = spark.createDataFrame([(1, "b", "x", 2.0, 0.0), (2, "a", "y", 0.0, -1.5), (3, "q", "x", 5.0, 1.0)],
                                "id int, c string, d string, n double, m double")
    d = encode.fit_dictionary(fit, ["c", "d"])
    m = Pipeline(stages=encode.one_hot_stages(["c", "d"]) + [encode.assembler(["c", "d"], ["n", "m"])]).fit(fit)
    want = {(r.id, i, v) for r in m.transform(fit).select("id", vector_to_array("features").alias("f")).collect()
            for i, v in enumerate(r.f) if v != 0}
    assert {tuple(r) for r in encode.assemble_cells(fit, "id", ["c", "d"], ["n", "m"], d).collect()} == want
