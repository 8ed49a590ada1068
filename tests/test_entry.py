from collections import Counter

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and {"date", "hour"} <= set(df.columns)


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 50


def test_some_queries_match_duckdb(spark):
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("customer", "part", "orders", "lineitem", "events"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    def norm(x):
        return round(x, 6) if isinstance(x, float) else x

    for name in ("vehicle_etl", "vehicle_metrics", "merge_edges", "pagerank", "connected_components"):
        df = E.queries()[name](spark, sf)
        got = Counter(tuple(norm(x) for x in r) for r in df.select(*sorted(df.columns)).collect())
        rel = con.sql(E.oracle_sql()[name])
        cols = rel.columns
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        want = Counter(tuple(norm(r[i]) for i in order) for r in rel.fetchall())
        assert got == want, name
