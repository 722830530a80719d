"""Runs a query and its SQL over the same tables."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE", "int": "INTEGER"}


def both(spark, sf_dir, query, sql):
    """(rows of the query, rows of the SQL), each sorted, by column name; types must agree."""
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    df = query(spark, sf_dir)
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    kinds = {d[0]: str(d[1]) for d in found.description}
    for f in df.schema:
        assert TYPES[f.dataType.simpleString()] == kinds[f.name], f.name
    order = sorted(names)
    theirs = sorted(repr(tuple(r[names.index(c)] for c in order)) for r in found.fetchall())
    ours = sorted(repr(tuple(r[c] for c in order)) for r in df.collect())
    return ours, theirs
