"""Type inference after missing-value tokens, held against pandas' own reader."""

import contextlib
import io
import math

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tabforge.session import scratch_path
from tabforge.sources import files, infer

# dtype that pandas gives -> type here
KINDS = {"int64": "bigint", "uint64": "decimal(20,0)", "float64": "double", "bool": "boolean"}
CELLS = ["1", "-2", "+7", "007", " 12 ", "9223372036854775807", "9223372036854775808", "-9223372036854775809",
         "18446744073709551616", "1.5", ".5", "5.", "-2E-3", "1e", "1e400", "1e-400", "inf", "-Infinity", " inf ", "NA", "", "None",
         " NA", "n/a", "-nan", "True", "FALSE", "tRue", " True", "text", "1_0", "0x10", "10d", "1,5", "+", ".", "   ", "\t3"]


def pandas_says(cells):
    text = "a,b\n" + "".join('"%s",x\n' % c.replace('"', '""') for c in cells)
    s = pd.read_csv(io.StringIO(text))["a"]
    kind = KINDS.get(str(s.dtype))
    if kind is None:
        bools = all(isinstance(v, bool) or pd.isna(v) for v in s)
        kind = "boolean" if bools else "string"
    return kind, [None if not isinstance(v, str) and pd.isna(v) else v for v in s]


def order_matters(cells):
    """Wide integers among other numbers: pandas decides by what it meets first."""
    wide = any(c.strip().lstrip("+-").isdigit() and not -2**63 <= int(c) < 2**63 for c in cells)
    other = any(not c.strip().lstrip("+-").isdigit() for c in cells)
    return wide and other


def check(spark, columns):
    n = max(map(len, columns))
    columns = [c + ["NA"] * (n - len(c)) for c in columns]
    df = spark.createDataFrame([tuple(c[i] for c in columns) + (i,) for i in range(n)],
                               ", ".join(f"c{k} string" for k in range(len(columns))) + ", i int")
    types = infer.infer_types(df)
    rows = infer.apply_types(df, types).orderBy("i").collect()
    for k, cells in enumerate(columns):
        if order_matters(cells):
            continue
        kind, values = pandas_says(cells)
        assert types[f"c{k}"] == kind, cells
        for r, v in zip(rows, values):
            got = r[f"c{k}"]
            if isinstance(v, str) and kind != "string":
                raise AssertionError(cells)
            if got is None or v is None:
                assert got is None and v is None, cells
            elif kind == "double":
                assert got == v or math.isclose(got, v, rel_tol=1e-15), cells
            else:
                assert got == v, cells


def test_single_cells_and_pairs(spark):
    check(spark, [[c] for c in CELLS])
    check(spark, [[c, "1"] for c in CELLS] + [[c, "2.5"] for c in CELLS] + [[c, "True"] for c in CELLS]
          + [["x", c] for c in CELLS])


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(CELLS), min_size=1, max_size=4), min_size=40, max_size=40))
def test_random_columns(spark, columns):
    check(spark, columns)


def test_wide_integers_among_fractions_stay_text(spark):
    df = spark.createDataFrame([("1.5",), ("123456789012345678901234567890",)], "a string")
    assert infer.infer_types(df) == {"a": "string"}


def test_file_round_trip(spark):
    rows = [(" NA ", "1", "True", "NULL"), ("x", "", "false", "nan"), (" y", " 3 ", "n/a", "")]
    df = spark.createDataFrame(rows, "s string, n string, b string, e string")
    path = files.write_csv(df, scratch_path(spark, "csv"))
    back = infer.read_csv_inferred(spark, path)
    assert dict(back.dtypes) == {"s": "string", "n": "double", "b": "boolean", "e": "double"}
    assert {tuple(r) for r in back.collect()} == {(" NA ", 1.0, True, None), ("x", None, False, None), (" y", 3.0, None, None)}
    same = infer.read_csv_inferred(spark, path, types={"n": "string"})
    assert dict(same.dtypes)["n"] == "string" and dict(same.dtypes)["b"] == "string"
    own = infer.read_csv_inferred(spark, path, tokens=("x",))
    assert dict(own.dtypes)["n"] == "double" and {r.s for r in own.collect()} == {" NA ", None, " y"}


def test_one_pass_for_all_columns(spark):
    df = spark.createDataFrame([("1", "2", 3)], "a string, b string, k int")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        infer.column_types(df).explain("formatted")
    assert buf.getvalue().count("Scan") <= 2 and "Join" not in buf.getvalue() and "Window" not in buf.getvalue()
    assert [r.column_name for r in infer.column_types(df).collect()] == ["a", "b"]
    assert infer.column_types(df.select("k")).collect() == []
    assert [(r.type, r.n_rows) for r in infer.column_types(df.where("false")).collect()] == [("double", 0)] * 2
    with pytest.raises(ValueError):
        infer.column_types(df, cols=["nope"])
