"""Runs registered queries beside their SQL in DuckDB and compares the rows."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def norm(v):
        if isinstance(v, float):
            return repr(round(v, 9) + 0.0)
        if hasattr(v, "as_tuple"):
            return repr(float(v))
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, int):
            return str(v)
        return repr(v)

    return [columns[i] for i in order], sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql, sf_dir):
    df = query(spark, sf_dir)
    mine = canonical(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    theirs = canonical([d[0] for d in found.description], found.fetchall())
    return mine, theirs
