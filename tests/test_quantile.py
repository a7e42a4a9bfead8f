"""Radix selection: exact for any values, all columns and ranks together, no sort."""

import contextlib
import io
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabforge.operators import quantile as Q
from tabforge.operators.clean import impute_median

QS = [0.0, 0.01, 0.25, 0.5, 0.613, 0.75, 0.99, 1.0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=30))
def test_images_order_like_doubles(values):
    v = np.array(values)
    images = Q.ordered_bits(v)
    assert [Q.from_ordered_bits(int(i)) for i in images] == [x + 0.0 for x in values]
    order = np.argsort(images, kind="stable")

    assert v[order].tolist() == sorted(values)


def test_equals_numpy_for_awkward_values(spark):
    r = np.random.default_rng(1)
    cols = {
        "wide": r.normal(size=4001) * 10.0 ** r.integers(-300, 300, 4001),  # every exponent
        "near": 1.0 + r.integers(0, 50, 4001) * 2.0**-52,  # neighbours in the last bits
        "ties": r.integers(-3, 3, 4001).astype(float),
        "hot": np.where(r.random(4001) < 0.7, 5.0, r.normal(size=4001)),
    }
    rows = [tuple(float(c[i]) for c in cols.values()) for i in range(4001)]
    rows += [(None, float("nan"), None, None)] * 50
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(7)
    got = Q.exact_quantiles(df, {c: QS for c in cols})
    for c, v in cols.items():
        s = np.sort(v)
        for q, x in zip(QS, got[c]):
            pos = q * (len(s) - 1)
            a, b = s[math.floor(pos)], s[math.ceil(pos)]
            want = a if a == b else (math.ceil(pos) - pos) * a + (pos - math.floor(pos)) * b
            assert x == want, (c, q)


def test_edges(spark):
    df = spark.createDataFrame([(5.0, 1, -0.0, float("inf"), None), (None, 2, 0.0, float("-inf"), float("nan")),
                                (None, 4, 0.0, 1.0, None)], "a double, b int, z double, i double, n double")
    got = Q.exact_quantiles(df, {"a": [0.0, 0.5, 1.0], "b": [0.5, 0.25], "z": [0.5], "i": [0.0, 0.5, 1.0], "n": [0.5]})
    assert got == {"a": [5.0, 5.0, 5.0], "b": [2.0, 1.5], "z": [0.0], "i": [float("-inf"), 1.0, float("inf")], "n": [None]}
    assert Q.exact_median(df.limit(0), "a") is None
    two = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    assert Q.exact_quantile(two, "x") == 1.5
    with pytest.raises(ValueError, match="within"):
        Q.exact_quantiles(two, {"x": [1.5]})
    with pytest.raises(ValueError, match="missing"):
        Q.exact_quantiles(two, {"y": [0.5]})


def test_rounds_are_bounded_and_plans_have_no_sort(spark, monkeypatch):
    plans, plain = [], Q._digit_counts

    def seen(*args):
        out = plain(*args)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            out.explain("formatted")
        plans.append(buf.getvalue())
        return out

    monkeypatch.setattr(Q, "_digit_counts", seen)
    df = spark.createDataFrame([(1.0 + i * 2.0**-52, float(i)) for i in range(200)], "x double, y double")
    Q.exact_quantiles(df, {"x": QS, "y": QS})
    assert 1 < len(plans) <= math.ceil(64 / Q.DIGIT_BITS)
    for p in plans:
        assert "Sort" not in p and "TakeOrdered" not in p and "Window" not in p
        assert p.count("Exchange (") <= 1 or p.count("\nExchange") <= 1


def test_impute_several_medians_together(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, 4.0), (3, 10.0, 8.0), (4, 2.0, float("nan"))], "id int, x double, y double")
    got = {r.id: (r.x, r.y) for r in impute_median(df, ["x", "y"]).collect()}
    assert got == {1: (1.0, 6.0), 2: (2.0, 4.0), 3: (10.0, 8.0), 4: (2.0, 6.0)}
