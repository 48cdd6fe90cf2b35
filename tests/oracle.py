"""Side-by-side runs of a registered query and its DuckDB oracle."""

from __future__ import annotations

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda x: f"{x:.9g}" if isinstance(x, float) else str(x)
    return [columns[i] for i in order], sorted(tuple(value(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir, query, sql):
    got = query(spark, sf_dir)
    con = connect(sf_dir).execute(sql)
    assert canonical([tuple(r) for r in got.collect()], got.columns) == canonical(con.fetchall(), [d[0] for d in con.description])
