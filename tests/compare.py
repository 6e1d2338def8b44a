"""Runs a query and its SQL over one data directory and compares their rows."""

import glob
import os

import duckdb


def connection(sf_dir):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def rows(columns, records):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    one = lambda x: round(x, 6) if isinstance(x, float) else x
    return sorted(tuple(repr(one(r[i])) for i in order) for r in records)


def both(spark, sf_dir, query, sql, con):
    df = query(spark, sf_dir)
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    assert sorted(names) == sorted(df.columns)
    return rows(df.columns, [tuple(r) for r in df.collect()]), rows(names, got.fetchall())
