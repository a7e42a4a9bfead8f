import importlib

from conftest import SF_SMALL


def test_entry_smoke(spark):
    E = importlib.import_module("__spark_entry__")
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["id", "priority", "status", "frontage", "veneer_area", "year_built",
                          "house_age", "c_acctbal", "c_mktsegment", "target", "split"]


def test_every_oracle_key_is_a_query():
    E = importlib.import_module("__spark_entry__")
    assert set(E.oracle_sql()) <= set(E.queries())


def test_queries_match_oracle_small(spark):
    """Every query with an oracle agrees with DuckDB on sf0.001."""
    import duckdb
    from tools.oracle_check import TABLES, canon

    E = importlib.import_module("__spark_entry__")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    qs, sql = E.queries(), E.oracle_sql()
    bad = []
    for k, q in sql.items():
        df = qs[k](spark, SF_SMALL)
        a = canon(df.columns, [tuple(r) for r in df.collect()])
        cur = con.execute(q)
        b = canon([d[0] for d in cur.description], cur.fetchall())
        if a != b:
            bad.append(k)
    assert bad == []
