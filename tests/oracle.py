"""Run a query's SQL on the sample tables and compare it with the query's rows."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def check(spark, sf_dir, run, sql):
    df = run(spark, sf_dir)
    names = sorted(df.columns)
    got = sorted(repr(tuple(r)) for r in df.select(*names).collect())
    result = connection(sf_dir).execute(sql)
    columns = [c[0] for c in result.description]
    assert sorted(columns) == names
    at = [columns.index(n) for n in names]
    want = sorted(repr(tuple(r[i] for i in at)) for r in result.fetchall())
    assert got == want
