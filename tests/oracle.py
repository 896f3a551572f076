"""Holds a query's rows against DuckDB's for its SQL."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def _plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return "null"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, (int, float)):
        return repr(float(x))
    return str(x)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def agree(spark, con, f, sql, sf_dir):
    got = f(spark, sf_dir)
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(got.columns) == sorted(names)
    ours, theirs = rows_of(got.columns, [tuple(r) for r in got.collect()]), rows_of(names, found.fetchall())
    assert len(ours) == len(theirs)
    assert ours == theirs
